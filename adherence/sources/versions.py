"""Partitioned Parquet tables that change by one pointer.

A warehouse folder holds ``<table>/load=<id>/<column>=<value>/.../*.parquet`` and ``_versions``.  A load
writes new folders only, of as many tables as it likes; ``publish`` then makes the next version, one small
file that names, for each partition of each table, the loads whose files make it up.  Readers take the
newest version, so all tables of a load change together, and what a killed job wrote is never seen.

A partition is replaced (a reload: facts, rejects, scores and roll-ups of a date), or a load is added to it
(deltas, merged when read).  A compaction folds the loads that it has read into one and keeps those that
came since.  A version also has the number of the last micro-batch of each stream that it holds, so a batch
that is repeated, even after its delta was folded, changes nothing.  A version is made by renaming a complete file to a name that must not exist; a job that finds it
taken merges its change into the newer version and tries again.  (On a store without an atomic rename, run
one job a warehouse at a time.)

The driver holds the pointer: a line for each partition, which are days.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Version files that stay for readers which have just taken one.
KEEP_POINTERS = 10


class ConflictError(RuntimeError):
    """Other jobs kept changing the version while this one tried to."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder, if it is there."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _pointers(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _names(spark, f"{root}/_versions") if n.startswith("v=")]


def pointer(spark: SparkSession, root: str, back: int = 0) -> dict:
    """The newest version, or the one so many before it: {"version": n, "tables": {table: {"schema", "by",
    "parts": {partition: [load, ...]}}}}."""
    found = _pointers(spark, root)
    if len(found) <= back:
        return {"version": 0, "tables": {}}
    fs, p = _fs(spark, f"{root}/_versions/{found[-1 - back]}")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put(spark: SparkSession, root: str, version: int, content: dict) -> bool:
    """Makes a version; False if another job has made it."""
    fs, target = _fs(spark, f"{root}/_versions/v={version:09d}.json")
    _, staged = _fs(spark, f"{root}/_versions/_tmp/{uuid.uuid4().hex}")
    out = fs.create(staged)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    done = not fs.exists(target) and fs.rename(staged, target)
    if not done:
        fs.delete(staged, False)
    return bool(done)


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders (``a=1/b=2``) below a load's folder."""
    out = [""]
    for _ in range(depth):
        out = [f"{o}/{n}".lstrip("/") for o in out for n in _names(spark, f"{path}/{o}") if "=" in n]
    return out


def names(spark: SparkSession, root: str) -> list[str]:
    """Tables that the newest version has."""
    return sorted(pointer(spark, root)["tables"])


def read_parts(spark: SparkSession, root: str, table: str, entry: dict, parts: dict[str, list[str]]) -> DataFrame:
    """The files of some partitions and loads of a table's ``entry`` in a pointer."""
    schema = StructType.fromJson(entry["schema"])
    paths = [f"{root}/{table}/load={load}/{part}" for part, loads in sorted(parts.items()) for load in loads]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths).select(*schema.names)


def read(spark: SparkSession, root: str, table: str, keep: Callable[[str], bool] | None = None, back: int = 0) -> DataFrame | None:
    """A table in the newest version (or ``back`` versions before); None if it has none.  ``keep`` says which
    partitions are looked at."""
    entry = pointer(spark, root, back)["tables"].get(table)
    if entry is None:
        return None
    return read_parts(spark, root, table, entry, {p: loads for p, loads in entry["parts"].items() if keep is None or keep(p)})


class Load:
    """New partitions of any tables of a warehouse, which appear together when it is published.  ``batch``:
    (stream, number) of the micro-batch that it is."""

    def __init__(self, spark: SparkSession, root: str, batch: tuple[str, int] | None = None):
        self.spark, self.root, self.batch = spark, root.rstrip("/"), batch
        self.id = f"{batch[0]}-{batch[1]:09d}" if batch else uuid.uuid4().hex
        self.changes: dict[str, dict] = {}

    def write(self, df: DataFrame, table: str, by: list[str], requested: list[str] = ()) -> None:
        """Stages partitions of a table.  Partitions that are ``requested`` (``a=1/b=2``) and get no rows come
        out empty.  A folder that an earlier attempt of the same load left is written anew."""
        path = f"{self.root}/{table}/load={self.id}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
        schema = df.select(*[c for c in df.columns if c not in by], *by).schema
        parts = dict.fromkeys(requested, False) | dict.fromkeys(_folders(self.spark, path, len(by)), True)
        self.changes[table] = {"schema": json.loads(schema.json()), "by": list(by), "parts": parts}

    def staged(self, table: str) -> DataFrame:
        """What this load has written of a table."""
        c = self.changes[table]
        return read_parts(self.spark, self.root, table, c, {p: [self.id] for p, rows in c["parts"].items() if rows})

    def published(self) -> bool:
        """Whether the newest version holds this micro-batch."""
        return self.batch is not None and pointer(self.spark, self.root).get("streams", {}).get(self.batch[0], -1) >= self.batch[1]

    def publish(self, add: bool = False, folded: dict[str, dict[str, list[str]]] | None = None, retain: int = 0) -> int:
        """Makes the version in which this load's partitions replace the present ones, are added to them
        (``add``), or take the place of the loads ``folded`` ({table: {partition: loads}}).  Folders that
        neither the new version nor the ``retain`` versions before it name are removed."""
        def change(version: dict) -> None:
            tables = version["tables"]
            if self.batch:
                version.setdefault("streams", {})[self.batch[0]] = self.batch[1]
            for table, c in self.changes.items():
                entry = tables.setdefault(table, {"parts": {}})
                entry["schema"], entry["by"] = c["schema"], c["by"]
                for part, rows in c["parts"].items():
                    now, own = entry["parts"].get(part, []), [self.id] if rows else []
                    if add:
                        loads = now + [x for x in own if x not in now]
                    elif folded is not None:
                        gone = set(folded.get(table, {}).get(part, []))
                        loads = own + [x for x in now if x not in gone and x != self.id]
                    else:
                        loads = own
                    if loads:
                        entry["parts"][part] = loads
                    else:
                        entry["parts"].pop(part, None)

        return _commit(self.spark, self.root, change, retain)


def _commit(spark: SparkSession, root: str, change: Callable[[dict], None], retain: int, tries: int = 20) -> int:
    for n in range(tries):
        before = pointer(spark, root)
        after = json.loads(json.dumps(before))
        change(after)
        after["version"] = before["version"] + 1
        if _put(spark, root, after["version"], after):
            _remove_superseded(spark, root, retain)
            return after["version"]
        time.sleep(0.05 * (n + 1))
    raise ConflictError(f"{root}: {tries} versions were made by others")


def _paths(version: dict) -> set[str]:
    return {f"{t}/load={load}/{part}" for t, entry in version["tables"].items() for part, loads in entry["parts"].items() for load in loads}


def _remove_superseded(spark: SparkSession, root: str, retain: int) -> None:
    """Folders that an older version names and the newest ``retain + 1`` don't; and old version files."""
    found = _pointers(spark, root)
    versions = [pointer(spark, root, back) for back in range(min(len(found), max(retain + 2, 2)))]
    live = set().union(*[_paths(v) for v in versions[: retain + 1]])
    for path in sorted(_paths(versions[-1]) - live) if len(versions) > retain + 1 else []:
        delete(spark, f"{root}/{path}")
    for name in found[: -max(KEEP_POINTERS, retain + 2)]:
        delete(spark, f"{root}/_versions/{name}")


def sweep(spark: SparkSession, root: str, older_than_hours: float = 48) -> int:
    """Removes load folders that no version file names and that are older than any running job: what killed
    jobs left.  Returns how many."""
    named = {"/".join(p.split("/")[:2]) for back in range(len(_pointers(spark, root))) for p in _paths(pointer(spark, root, back))}
    limit, n = (time.time() - older_than_hours * 3600) * 1000, 0
    for table in _names(spark, root):
        for load in _names(spark, f"{root}/{table}") if not table.startswith("_") else []:
            if load.startswith("load=") and f"{table}/{load}" not in named:
                fs, p = _fs(spark, f"{root}/{table}/{load}")
                if fs.getFileStatus(p).getModificationTime() < limit:
                    fs.delete(p, True)
                    n += 1
    return n


def between(column: str, lo=None, hi=None) -> Callable[[str], bool]:
    """Partitions whose integer ``column`` lies in [lo, hi]."""
    def keep(part: str) -> bool:
        value = dict(x.split("=", 1) for x in part.split("/")).get(column, "")
        try:
            number = int(value)
        except ValueError:
            return lo is None and hi is None
        return (lo is None or number >= lo) and (hi is None or number <= hi)

    return keep


def partition_of(**values) -> str:
    """``a=1/b=2``, for values that need no escaping."""
    return "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in values.items())
