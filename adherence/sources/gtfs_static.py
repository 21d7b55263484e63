"""GTFS static archive (S2, S4): member staging and typed-as-string CSV scans.

A national archive is hundreds of MB; it is never held whole.  ``list_members`` reads only the
zip directory in a task; ``stage_members`` then gives every (archive, member) pair its own task,
which stream-decompresses that member into a staging folder on shared storage (write to a
temporary name, then an atomic rename, so a retried or speculative task is harmless).  The staged
text files are ordinary splittable CSV for ``spark.read.csv``.
"""

from __future__ import annotations

import csv
import io
import os
import shutil
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GTFS_COLUMNS = {
    "agency": ["agency_id", "agency_name"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"],
    "trips": ["route_id", "service_id", "trip_id"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
                 "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
}


def _fs(uri: str):
    """(pyarrow filesystem, path) for a Spark-style URI: file:, s3a:/s3:, gs:, hdfs:, or a bare path."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("s3a://") or uri.startswith("s3n://"):
        uri = "s3://" + uri.split("://", 1)[1]
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def list_members(archives: DataFrame) -> DataFrame:
    """(path) rows of zip archives -> (path, member, size) rows; only the zip directory is read."""
    def run(batches):
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                fs, fp = _fs(p)
                with fs.open_input_file(fp) as f, zipfile.ZipFile(f) as zf:
                    rows += [(p, i.filename, i.file_size) for i in zf.infolist() if not i.is_dir()]
            yield pd.DataFrame(rows, columns=["path", "member", "size"])
    return archives.select("path").mapInPandas(run, "path string, member string, size long")


def stage_members(members: DataFrame, staging: str) -> DataFrame:
    """One task per (archive, member): stream the member to ``{staging}/{table}/{archive-id}.txt``.

    Written under ``_tmp`` (which readers of the folder pass over) and then moved into place; the content
    is a pure function of the archive, so a retried or speculative task rewrites the same bytes, and
    what a killed task leaves behind is never read."""
    def run(batches):
        for pdf in batches:
            out = []
            for p, m in zip(pdf["path"], pdf["member"]):
                table = os.path.splitext(os.path.basename(m))[0]
                arch = uuid.uuid5(uuid.NAMESPACE_URL, p).hex[:16]
                target = f"{staging.rstrip('/')}/{table}/{arch}.txt"
                sfs, sp = _fs(p)
                tfs, tp = _fs(target)
                folder = tp.rsplit("/", 1)[0]
                tfs.create_dir(f"{folder}/_tmp", recursive=True)
                tmp = f"{folder}/_tmp/{uuid.uuid4().hex}"
                with sfs.open_input_file(sp) as f, zipfile.ZipFile(f) as zf, zf.open(m) as src, \
                        tfs.open_output_stream(tmp) as dst:
                    shutil.copyfileobj(src, dst, 1 << 20)
                tfs.move(tmp, tp)
                out.append((p, m, table, target, tfs.get_file_info(tp).size))
            yield pd.DataFrame(out, columns=["path", "member", "table", "staged_path", "bytes"])
    n = max(1, members.count())  # a handful of members per archive: one task each
    # range partitioning over n distinct keys puts each member in its own partition (hash could pair two)
    return members.repartitionByRange(n, "path", "member").mapInPandas(
        run, "path string, member string, table string, staged_path string, bytes long")


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a table by their own header.  Tasks read the first line of each file; the driver gets a
    header for each file, one an archive."""
    def run(batches):
        for pdf in batches:
            names = []
            for p in pdf["path"]:
                fs, fp = _fs(p)
                with fs.open_input_stream(fp, compression=None) as f:
                    first = io.TextIOWrapper(f, encoding="utf-8-sig", newline="").readline()
                names.append(next(csv.reader([first.rstrip("\r\n")]), []))
            yield pd.DataFrame({"path": pdf["path"], "names": names})

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path")
    out: dict[tuple[str, ...], list[str]] = {}
    for r in files.mapInPandas(run, "path string, names array<string>").collect():
        out.setdefault(tuple(n.strip() for n in r.names), []).append(r.path)
    return out


def read_table(spark: SparkSession, path: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """Header CSV under an explicit schema: every column a string (no inference), bound by the names in
    each file's own header, as archives order their columns differently; extra columns ignored, missing
    ones NULL."""
    cols = columns or GTFS_COLUMNS[table]
    out = None
    for names, files in sorted(headers(spark, path).items()):
        # a name that comes twice counts once, where it stands first
        own = [n if names.index(n) == i else f"{n}#{i}" for i, n in enumerate(names)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in own])
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("encoding", "UTF-8").csv(sorted(files))
        part = raw.select(*[F.col(f"`{c}`") if c in own else F.lit(None).cast("string").alias(c) for c in cols])
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], ", ".join(f"{c} string" for c in cols))


def read_feed(spark: SparkSession, staged: str, tables=("agency", "routes", "trips", "stops", "stop_times")):
    """All GTFS tables of a staged feed as string DataFrames."""
    from adherence.operators.match import Gtfs

    t = {name: read_table(spark, f"{staged}/{name}", name) for name in tables}
    return Gtfs(agency=t.get("agency"), routes=t["routes"], trips=t["trips"], stops=t["stops"],
                stop_times=t["stop_times"])


def read_optional(spark: SparkSession, staged: str, table: str) -> DataFrame | None:
    """A table that a feed may lack; None if it isn't there."""
    from adherence.session import path_exists

    return read_table(spark, f"{staged}/{table}", table) if path_exists(spark, f"{staged}/{table}") else None
