"""Raw landing zone (S1, S3, S6-S11): file layout, snapshot choice, sidecars, audit, inventory.

Layout::

    {base}/static/{yyyy-mm-dd}/gtfs.zip          + metadata.json
    {base}/realtime/{yyyy-mm-dd}/{HH-MM-SS}/tripupdates.pb + metadata.json
    {base}/ingest_runs.jsonl                       (append-only audit log)

Listing uses the ``binaryFile`` source without selecting ``content`` (so no bytes are read);
dates and snapshot times come from the path.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adherence.operators.dims import literal_table
from adherence.sources.tripupdates import with_layout

# The landing folder's file names above, the members an archive must have, and the fields of its
# sidecar and audit records.
REQUIRED_MEMBERS = ["stops.txt", "routes.txt", "trips.txt", "stop_times.txt"]

METADATA_SCHEMA = T.StructType([
    T.StructField("operator", T.StringType()),
    T.StructField("feed_type", T.StringType()),
    T.StructField("pulled_at_utc", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("api_status", T.IntegerType()),
    T.StructField("operator_code", T.StringType()),
    T.StructField("service_date", T.StringType()),
])

AUDIT_SCHEMA = T.StructType([
    T.StructField("timestamp_utc", T.StringType()),
    T.StructField("feed_type", T.StringType()),
    T.StructField("service_date", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("api_status", T.IntegerType()),
    T.StructField("dag_id", T.StringType()),
    T.StructField("task_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("extras", T.StringType()),
])


class MissingInputError(FileNotFoundError):
    """A required landing file or member is absent."""


def list_files(spark: SparkSession, base: str, kind: str, glob: str) -> DataFrame:
    """Path, length, modificationTime, service_date, snapshot_ts (content never read)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(f"{base}/{kind}"))
    return with_layout(df.select("path", "length", "modificationTime"))


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The latest snapshot of each service date (lexicographic max of the HH-MM-SS folder).

    A per-date max (map-side combined) joined back on (date, time): no window holds a whole date."""
    last = snapshots.groupBy("service_date").agg(F.max("snapshot_ts").alias("snapshot_ts"))
    return snapshots.join(last, ["service_date", "snapshot_ts"], "left_semi")


def latest_snapshot_path(spark: SparkSession, base: str, service_date: str) -> str:
    """S7 for one date; missing folder or file is an error (only one path reaches the driver)."""
    snaps = list_files(spark, base, "realtime", "tripupdates.pb").filter(
        F.col("service_date") == F.lit(service_date).cast("date"))
    row = snaps.orderBy(F.col("snapshot_ts").desc()).select("path").first()
    if row is None:
        raise MissingInputError(f"no realtime snapshots for {service_date}")
    return row.path


def missing_members(members: DataFrame, required=REQUIRED_MEMBERS) -> DataFrame:
    """S3: required archive members that are absent (left-anti of required names vs found)."""
    spark = members.sparkSession
    req = literal_table(spark, [(m,) for m in required], "member string")
    found = members.select(F.regexp_extract("member", r"([^/]+)$", 1).alias("member"))
    return req.join(found, "member", "left_anti")


def check_members(members: DataFrame, required=REQUIRED_MEMBERS) -> None:
    missing = [r.member for r in missing_members(members, required).collect()]  # at most len(required) rows
    if missing:
        raise MissingInputError(f"GTFS archive is missing required members: {sorted(missing)}")


# ------------------------------------------------------------------------------- sidecars


def write_sidecars(df: DataFrame, path: str) -> None:
    """One JSON metadata record per landed file (operator, feed_type, pulled_at_utc, ...)."""
    df.write.mode("append").json(path)


def read_sidecars(spark: SparkSession, paths) -> DataFrame:
    """Tolerant sidecar read: a missing or malformed field is NULL, never a failure."""
    schema = T.StructType(METADATA_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(schema)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
          .option("recursiveFileLookup", "true").json(paths))
    pulled = F.coalesce(
        F.try_to_timestamp("pulled_at_utc", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
        F.try_to_timestamp("pulled_at_utc", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp("pulled_at_utc", F.lit("yyyy-MM-dd'T'HH:mm:ss")),
    )
    return df.withColumn("path", F.input_file_name()).withColumn("pulled_at", pulled).drop("_corrupt_record")


def static_age_days(sidecars: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q7 input: age in days of each static pull against an injected ``as_of`` (UTC)."""
    asof = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    return sidecars.filter(F.col("feed_type") == "static").select(
        F.col("service_date").try_cast("date").alias("service_date"),
        ((F.unix_micros(asof) - F.unix_micros("pulled_at")) / 86_400_000_000.0).alias("age_days"),
    )


# ------------------------------------------------------------------------------- audit log


def append_audit(df: DataFrame, path: str) -> None:
    """Append-only JSON-lines audit records (10 fields + extras)."""
    df.select([F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in AUDIT_SCHEMA.fields]).write.mode("append").json(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).option("mode", "PERMISSIVE").json(path)


# ------------------------------------------------------------------------------- inventory


def inventory(spark: SparkSession, base: str, entity_counts: DataFrame | None = None,
              audit: DataFrame | None = None) -> DataFrame:
    """Per service date: static size and pull time, number of snapshots, the latest snapshot,
    its bytes and entity count, and the audit lines of that date."""
    static = list_files(spark, base, "static", "gtfs.zip").groupBy("service_date").agg(
        F.sum("length").alias("static_bytes"), F.max("modificationTime").alias("static_modified"))
    snaps = list_files(spark, base, "realtime", "tripupdates.pb")
    per_day = snaps.groupBy("service_date").agg(
        F.count(F.lit(1)).alias("n_snapshots"),
        F.max("snapshot_ts").alias("latest_snapshot"),
        F.max_by("length", "snapshot_ts").alias("latest_bytes"),
        F.max_by("path", "snapshot_ts").alias("latest_path"),
    )
    out = static.join(per_day, "service_date", "full_outer")
    if entity_counts is not None:
        out = out.join(entity_counts.select(F.col("path").alias("latest_path"), "entity_count"), "latest_path", "left")
    if audit is not None:
        lines = audit.groupBy(F.col("service_date").try_cast("date").alias("service_date")).agg(
            F.count(F.lit(1)).alias("audit_lines"))
        out = out.join(lines, "service_date", "left")
    return out

