"""GTFS-Realtime TripUpdates source.

A snapshot is decoded into its nested entities and no further: the protobuf messages are turned into rows of
``ENTITY`` field by field, a field that is not set being NULL (proto2, so a delay of 0 differs from an absent
one).  The JSON rendering of a feed has the same shape.  One flattening of two ``explode``s serves both, and
the rules of the feed (blank ids, which event counts, zero as missing) are its Column expressions.

``TripUpdatesSource`` is the data source of a landing folder, for batch and for streams: it plans one
partition for each snapshot, from the folder names alone; filters on ``service_date`` and ``snapshot_ts``
decide which folders are listed at all; a snapshot that cannot be read or decoded becomes a row with
``error`` set (``dead_letters``) and fails nothing.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

from adherence.constants import DEFAULT_ZONE
from adherence.functions import delay as DL
from adherence.functions import gtfs_time as GT
from adherence.sources.gtfs_static import _fs

_EVENT = T.StructType([T.StructField("delay", T.IntegerType()), T.StructField("time", T.LongType())])
ENTITY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("trip_update", T.StructType([
        T.StructField("trip", T.StructType([
            T.StructField("trip_id", T.StringType()), T.StructField("route_id", T.StringType()),
            T.StructField("start_date", T.StringType()), T.StructField("start_time", T.StringType())])),
        T.StructField("stop_time_update", T.ArrayType(T.StructType([
            T.StructField("stop_sequence", T.LongType()), T.StructField("stop_id", T.StringType()),
            T.StructField("arrival", _EVENT), T.StructField("departure", _EVENT)]))),
    ])),
])
JSON_SCHEMA = T.StructType([T.StructField("entity", T.ArrayType(ENTITY))])
#: Entities of one Arrow batch.
_BATCH = 500

# fixed values: public GTFS-Realtime field numbers of the TripUpdates subset that is read
_FIELDS = {
    "FeedHeader": [("gtfs_realtime_version", 1, "string", None), ("timestamp", 3, "uint64", None)],
    "FeedMessage": [("header", 1, "message", "FeedHeader"), ("entity", 2, "repeated", "FeedEntity")],
    "FeedEntity": [("id", 1, "string", None), ("is_deleted", 2, "bool", None), ("trip_update", 3, "message", "TripUpdate")],
    "TripUpdate": [("trip", 1, "message", "TripDescriptor"), ("stop_time_update", 2, "repeated", "StopTimeUpdate"),
                   ("timestamp", 4, "uint64", None), ("delay", 5, "int32", None)],
    "TripDescriptor": [("trip_id", 1, "string", None), ("start_time", 2, "string", None),
                       ("start_date", 3, "string", None), ("route_id", 5, "string", None)],
    "StopTimeUpdate": [("stop_sequence", 1, "uint32", None), ("arrival", 2, "message", "StopTimeEvent"),
                       ("departure", 3, "message", "StopTimeEvent"), ("stop_id", 4, "string", None)],
    "StopTimeEvent": [("delay", 1, "int32", None), ("time", 2, "int64", None)],
}
_PACKAGE = "adherence_rt"


@functools.lru_cache(maxsize=1)
def message_classes() -> dict:
    """Build the message classes once per Python worker."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    fdp = descriptor_pb2.FileDescriptorProto(name="adherence_rt.proto", package=_PACKAGE, syntax="proto2")
    ftype = descriptor_pb2.FieldDescriptorProto
    scalar = {"string": ftype.TYPE_STRING, "uint64": ftype.TYPE_UINT64, "bool": ftype.TYPE_BOOL,
              "int32": ftype.TYPE_INT32, "uint32": ftype.TYPE_UINT32, "int64": ftype.TYPE_INT64}
    for msg, fields in _FIELDS.items():
        m = fdp.message_type.add(name=msg)
        for name, num, kind, ref in fields:
            f = m.field.add(name=name, number=num)
            if kind in ("message", "repeated"):
                f.type = ftype.TYPE_MESSAGE
                f.type_name = f".{_PACKAGE}.{ref}"
                f.label = ftype.LABEL_REPEATED if kind == "repeated" else ftype.LABEL_OPTIONAL
            else:
                f.type = scalar[kind]
                f.label = ftype.LABEL_OPTIONAL
    pool = descriptor_pool.DescriptorPool()
    pool.AddSerializedFile(fdp.SerializeToString())
    return {name: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{_PACKAGE}.{name}"))
            for name in _FIELDS}


def plain(message) -> dict:
    """The set fields of a message, messages inside it likewise."""
    value = lambda f, v: plain(v) if f.type == f.TYPE_MESSAGE else v
    return {f.name: [value(f, x) for x in v] if f.is_repeated else value(f, v) for f, v in message.ListFields()}


def entities(payload: bytes) -> list[dict]:
    """The entities of one snapshot, nested."""
    return [plain(e) for e in message_classes()["FeedMessage"].FromString(payload).entity]


_ROW = T.StructType([T.StructField("path", T.StringType()), T.StructField("e", ENTITY)])


def _batches(rows: list[dict], schema: T.StructType, **fixed):
    """Arrow batches of entities ``e`` with the other columns of ``schema`` fixed."""
    arrow = to_arrow_schema(schema)
    for i in range(0, len(rows), _BATCH):
        part = rows[i:i + _BATCH]
        yield pa.RecordBatch.from_arrays([pa.array(part if f.name == "e" else [fixed[f.name]] * len(part), f.type) for f in arrow], schema=arrow)


def read_snapshots(spark: SparkSession, paths, glob: str = "*.pb") -> DataFrame:
    """Snapshot files with their path-derived service date and UTC snapshot time.
    Layout ``realtime/{yyyy-mm-dd}/{HH-MM-SS}/tripupdates.pb``."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(paths))
    return with_layout(df)


def with_layout(files: DataFrame) -> DataFrame:
    date = F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/", 1)
    snap = F.regexp_extract("path", r"/\d{4}-\d{2}-\d{2}/(\d{2}-\d{2}-\d{2})/", 1)
    return files.withColumn("service_date", F.nullif(date, F.lit("")).try_cast("date")).withColumn(
        "snapshot_ts", F.try_to_timestamp(F.concat_ws(" ", date, F.regexp_replace(snap, "-", ":")),
                                          F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))


def decode(files: DataFrame, zero_is_missing: bool = False, zone: str = DEFAULT_ZONE) -> DataFrame:
    """binaryFile rows -> flat TripUpdates rows with the trip start epoch.

    Each snapshot is a few MB and is decoded whole inside one task; files are spread over tasks
    by the file source (one file = one split)."""
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                yield from _batches(entities(content.as_py()), _ROW, path=path.as_py())

    nested = files.select("path", "content").mapInArrow(run, _ROW)
    return flatten(with_layout(nested), ["path", "service_date", "snapshot_ts"], zero_is_missing, zone)


def flatten(nested: DataFrame, keep: list[str], zero_is_missing: bool = False, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Entities ``e`` -> one row for each stop time update, the columns ``keep`` beside it.  F8: blank ids
    are NULL, and updates without a stop id are dropped; F7/D2: the arrival counts if it is there, else the
    departure; D1: a zero is a value, unless ``zero_is_missing``."""
    u = nested.where(F.col("e.trip_update").isNotNull()).select(
        *keep, F.col("e.trip_update.trip").alias("trip"), F.explode("e.trip_update.stop_time_update").alias("u"))
    number = (lambda c: F.nullif(c, F.lit(0))) if zero_is_missing else (lambda c: c)
    event = lambda field: number(DL.choose_event(F.col("u.arrival"), F.col("u.departure"), field))
    out = u.select(
        *keep, *[DL.blank_to_null(F.col(f"trip.{c}")).alias(c) for c in ("trip_id", "route_id", "start_date", "start_time")],
        DL.blank_to_null(F.col("u.stop_id")).alias("stop_id"), number(F.col("u.stop_sequence")).alias("stop_sequence"),
        event("delay").alias("delay_seconds"), event("time").alias("actual_epoch"))
    return out.where(F.col("stop_id").isNotNull()).withColumn("trip_start_epoch", GT.rt_start_to_epoch("start_date", "start_time", zone))


def entity_counts(files: DataFrame) -> DataFrame:
    """TripUpdate entity count per snapshot file (decoded in the tasks)."""
    def run(batches):
        cls = None
        for pdf in batches:
            cls = cls or message_classes()["FeedMessage"]
            n = []
            for content in pdf["content"]:
                m = cls()
                m.ParseFromString(bytes(content))
                n.append(len(m.entity))
            yield pd.DataFrame({"path": pdf["path"], "entity_count": n})
    return files.select("path", "content").mapInPandas(run, "path string, entity_count long")


def require_rows(flat: DataFrame, what: str = "TripUpdates") -> DataFrame:
    """An empty feed is an error (a one-row probe, not a count)."""
    if flat.isEmpty():
        raise ValueError(f"no {what} parsed")
    return flat


def flatten_json(feed: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """S5 for JSON feeds (a row for each document, ``entity`` in it): the same flattening, native only."""
    return flatten(feed.select(F.input_file_name().alias("path"), F.explode("entity").alias("e")), ["path"], zone=zone)


def read_json(spark: SparkSession, paths) -> DataFrame:
    return flatten_json(spark.read.schema(JSON_SCHEMA).option("multiLine", "true").json(paths))


# ---------------------------------------------------------------------------- landing folder as a data source

SNAPSHOT = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("service_date", T.DateType()), T.StructField("snapshot_ts", T.TimestampNTZType()),
    T.StructField("error", T.StringType()), T.StructField("e", ENTITY)])
FILE = "tripupdates.pb"
_COMPARE = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}


class _Snapshot(InputPartition):
    def __init__(self, date: str, time: str):
        self.date, self.time = date, time


class _Folder:
    """Snapshots ``<root>/<yyyy-mm-dd>/<HH-MM-SS>/tripupdates.pb``, found by folder names."""

    def __init__(self, options):
        self.root, self.latest = options["path"].rstrip("/"), options.get("latest", "false").lower() == "true"
        self.tests = []  # (column, test of its value)
        for name, test in (("from", operator.ge), ("to", operator.le)):
            if options.get(name):
                bound = dt.date.fromisoformat(options[name])
                self.tests.append(("service_date", lambda v, test=test, bound=bound: test(v, bound)))

    def _folders(self, *parts: str) -> list[str]:
        from pyarrow.fs import FileSelector, FileType

        fs, path = _fs("/".join([self.root, *parts]))
        found = fs.get_file_info(FileSelector(path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == FileType.Directory)

    def _passes(self, column: str, value) -> bool:
        return all(test(value) for c, test in self.tests if c == column)

    def snapshots(self, after: str = "") -> list[_Snapshot]:
        """Those that the filters let pass, in order; ``after``: a "date/time" that comes before them."""
        out = []
        for date in self._folders():
            if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", date) or date < after[:10] or not self._passes("service_date", dt.date.fromisoformat(date)):
                continue
            times = [t for t in self._folders(date) if re.fullmatch(r"\d{2}-\d{2}-\d{2}", t) and f"{date}/{t}" > after
                     and self._passes("snapshot_ts", _moment(date, t))]
            out += [_Snapshot(date, t) for t in (times[-1:] if self.latest else times)]
        return out

    def read(self, partition: _Snapshot):
        place = f"{self.root}/{partition.date}/{partition.time}/{FILE}"
        fixed = {"path": place, "service_date": dt.date.fromisoformat(partition.date), "snapshot_ts": _moment(partition.date, partition.time), "error": None}
        try:
            fs, path = _fs(place)
            with fs.open_input_stream(path, compression=None) as f:
                rows = entities(f.read())
        except Exception as e:  # noqa: BLE001  whatever is wrong with it, it is that snapshot's letter
            yield from _batches([None], SNAPSHOT, **(fixed | {"error": f"{type(e).__name__}: {str(e)[:500]}"}))
            return
        yield from _batches(rows, SNAPSHOT, **fixed)


def _moment(date: str, time: str) -> dt.datetime:
    return dt.datetime.strptime(f"{date} {time}", "%Y-%m-%d %H-%M-%S")


class _Reader(_Folder, DataSourceReader):
    def pushFilters(self, filters):
        """Filters on the two columns that folder names tell pick the folders; all are applied again after."""
        for f in filters:
            column = getattr(f, "attribute", (None,))
            if column in (("service_date",), ("snapshot_ts",)):
                if type(f) in _COMPARE:
                    self.tests.append((column[0], lambda v, test=_COMPARE[type(f)], bound=f.value: test(v, bound)))
                elif isinstance(f, In):
                    self.tests.append((column[0], lambda v, values=frozenset(f.value): v in values))
            yield f

    def partitions(self):
        return self.snapshots() or [_Snapshot("", "")]

    def read(self, partition):
        return super().read(partition) if partition.date else iter(())


class _StreamReader(_Folder, DataSourceStreamReader):
    """The offset is the newest "date/time" folder; each micro-batch has the snapshots since the last."""

    def initialOffset(self):
        return {"after": ""}

    def latestOffset(self):
        found = self.snapshots()
        return {"after": f"{found[-1].date}/{found[-1].time}" if found else ""}

    def partitions(self, start, end):
        return [s for s in self.snapshots(start["after"]) if f"{s.date}/{s.time}" <= end["after"]]

    def commit(self, end):
        """Nothing to give back: the landing folder keeps its files."""


class TripUpdatesSource(DataSource):
    """``spark.read.format("tripupdates").load(folder)``; options ``from``, ``to`` (dates) and ``latest`` (the
    last snapshot of each date only)."""

    @classmethod
    def name(cls):
        return "tripupdates"

    def schema(self):
        return SNAPSHOT

    def reader(self, schema):
        return _Reader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def load(spark: SparkSession, folder: str, stream: bool = False, **options) -> DataFrame:
    """Rows of ``SNAPSHOT`` of a ``realtime`` folder: one for each entity, and one for each dead snapshot."""
    spark.dataSource.register(TripUpdatesSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.readStream if stream else spark.read
    return reader.format("tripupdates").options(**options).load(folder)


def updates(snapshots: DataFrame, zero_is_missing: bool = False, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Flat TripUpdates rows of ``load``'s rows."""
    return flatten(snapshots, ["path", "service_date", "snapshot_ts"], zero_is_missing, zone)


def dead_letters(snapshots: DataFrame) -> DataFrame:
    """(path, service_date, snapshot_ts, error) of the snapshots that could not be decoded."""
    return snapshots.where(F.col("error").isNotNull()).select("path", "service_date", "snapshot_ts", "error")
