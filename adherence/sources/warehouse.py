"""Warehouse tables on Parquet and the wide CSV exchange format.

Fact tables are partitioned by ``date_key`` (energy scores by ``date_key, region_id``).  The jobs load
them as versions (``versions``): a reload of a service date stages new folders of facts, rejects, roll-up and
scores, and one pointer switches them together; ``read_star`` and ``load_star`` follow it.  ``write_facts``
and ``write_energy`` write plain folders by dynamic partition overwrite, for exchange with other readers:
there each partition is replaced on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adherence.functions import gtfs_time as GT
from adherence.sources import versions as V

HISTOGRAM_TABLE, TRIPS_TABLE = "rollup_delays", "rollup_trips"

FACT_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType()),
    T.StructField("route_key", T.LongType()),
    T.StructField("stop_key", T.LongType()),
    T.StructField("vehicle_type_key", T.IntegerType()),
    T.StructField("trip_id", T.StringType(), False),
    T.StructField("stop_sequence", T.IntegerType(), False),
    T.StructField("scheduled_arrival", T.TimestampNTZType(), False),
    T.StructField("actual_arrival", T.TimestampNTZType()),
    T.StructField("delay_seconds", T.IntegerType()),
    T.StructField("data_source", T.StringType()),
])

WIDE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()), T.StructField("full_date", T.StringType()),
    T.StructField("day_name", T.StringType()), T.StructField("day_of_week", T.IntegerType()),
    T.StructField("trip_id", T.StringType()), T.StructField("stop_sequence", T.IntegerType()),
    T.StructField("scheduled_arrival", T.StringType()), T.StructField("actual_arrival", T.StringType()),
    T.StructField("delay_seconds", T.IntegerType()), T.StructField("data_source", T.StringType()),
    T.StructField("route_id", T.StringType()), T.StructField("route_short_name", T.StringType()),
    T.StructField("route_long_name", T.StringType()), T.StructField("stop_id", T.StringType()),
    T.StructField("stop_name", T.StringType()), T.StructField("stop_lat", T.DoubleType()),
    T.StructField("stop_lon", T.DoubleType()), T.StructField("type_name", T.StringType()),
    T.StructField("hour_of_day", T.IntegerType()),
])

ENERGY_WIDE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()), T.StructField("full_date", T.StringType()),
    T.StructField("region_id", T.StringType()), T.StructField("region_name", T.StringType()),
    T.StructField("route_id", T.StringType()), T.StructField("route_short_name", T.StringType()),
    T.StructField("route_long_name", T.StringType()), T.StructField("trip_count", T.IntegerType()),
    T.StructField("avg_km", T.DoubleType()), T.StructField("total_km", T.DoubleType()),
    T.StructField("p90_hours", T.DoubleType()), T.StructField("total_hours", T.DoubleType()),
    T.StructField("avg_stops", T.DoubleType()), T.StructField("delay_hours", T.DoubleType()),
    T.StructField("energy_score", T.DoubleType()), T.StructField("is_flagged", T.StringType()),
    T.StructField("flag_reasons", T.StringType()),
])


class EmptyExportError(ValueError):
    """Refusing to export an empty delay table."""


def arranged(facts: DataFrame) -> DataFrame:
    """Facts range-partitioned and sorted on (date_key, route_key, trip_id): each task writes a contiguous key
    range, so it touches few date folders, and a very large date is split over several tasks instead of
    landing in one."""
    return facts.repartitionByRange("date_key", "route_key", "trip_id").sortWithinPartitions("date_key", "route_key", "trip_id", "stop_sequence")


def write_facts(facts: DataFrame, path: str, requested: int | None = None) -> None:
    """Replace the service dates present in ``facts`` (dynamic partition overwrite).  A ``requested``
    date key that ``facts`` has no rows of is emptied: nothing stale stays behind a reload.

    Files are capped by ``spark.sql.files.maxRecordsPerFile``."""
    spark = facts.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    arranged(facts).write.mode("overwrite").partitionBy("date_key").parquet(path)
    if requested is not None and facts.filter(F.col("date_key") == requested).isEmpty():
        V.delete(spark, f"{path.rstrip('/')}/date_key={requested}")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a dimension, oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [str(s.getPath().toString()) for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("v=")]
    return sorted(v for v in found if fs.exists(jvm.org.apache.hadoop.fs.Path(v, "_SUCCESS")))


def read_dim(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of a dimension; None if there is none.  A read error is one: it never
    passes for a first load."""
    found = _versions(spark, path)
    return spark.read.parquet(found[-1]) if found else None


def replace_dim(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """``df`` as the next version of a dimension, read back.  Readers switch when the version is complete,
    so a job that fails leaves the old one in place; versions before the last ``keep`` are removed."""
    spark = df.sparkSession
    old = _versions(spark, path)
    last = int(old[-1].rsplit("v=", 1)[1]) if old else 0
    df.write.parquet(f"{path.rstrip('/')}/v={last + 1:09d}")
    for v in old[: max(0, len(old) + 1 - keep)]:
        V.delete(spark, v)
    return read_dim(spark, path)


def write_energy(scores: DataFrame, path: str, requested: list[tuple[int, str]] | None = None) -> None:
    """L8 + D23: replace the (date_key, region_id) partitions produced, and also empty every
    requested partition that produced nothing (dynamic mode alone would leave it untouched)."""
    spark = scores.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    scores.repartition("date_key", "region_id").write.mode("overwrite").partitionBy("date_key", "region_id").parquet(path)
    if requested:
        dates = sorted({d for d, _ in requested})
        produced = {(r.date_key, r.region_id) for r in scores.filter(F.col("date_key").isin(dates))
                    .select("date_key", "region_id").distinct().collect()}   # requested partitions only
        for date_key, region in requested:  # requested partitions: a few per run, not data-sized
            if (date_key, region) not in produced:
                V.delete(spark, f"{path.rstrip('/')}/date_key={date_key}/region_id={region}")


def read_star(spark: SparkSession, path: str, start_key: int | None = None, end_key: int | None = None) -> DataFrame:
    """Fact reader; the literal date_key bounds prune partitions statically.  A table that has versions
    is read in its newest one, of which only the partitions in the bounds are listed."""
    root, table = path.rstrip("/").rsplit("/", 1)
    df = V.read(spark, root, table, V.between("date_key", start_key, end_key))
    if df is None:
        df = spark.read.parquet(path)
    if start_key is not None:
        df = df.filter(F.col("date_key") >= start_key)
    if end_key is not None:
        df = df.filter(F.col("date_key") <= end_key)
    return df


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """The wide delay CSV (gz is read natively); bad timestamps become NULL; the hour is
    derived from the scheduled arrival when absent."""
    return _typed(spark.read.schema(WIDE_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path))


def parse_wide(lines: DataFrame) -> DataFrame:
    """The same for lines (``value``) that are in a frame already, without a header."""
    parsed = F.from_csv("value", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in WIDE_SCHEMA.fields), {"mode": "PERMISSIVE"})
    return _typed(lines.select(parsed.alias("r")).select("r.*"))


def _typed(raw: DataFrame) -> DataFrame:
    sched = F.try_to_timestamp("scheduled_arrival").cast("timestamp_ntz")
    act = F.try_to_timestamp("actual_arrival").cast("timestamp_ntz")
    return raw.withColumn("full_date", F.col("full_date").try_cast("date")).withColumn(
        "scheduled_arrival", sched).withColumn("actual_arrival", act).withColumn(
        "hour_of_day", F.coalesce(F.col("hour_of_day"), GT.hour_of("scheduled_arrival")))


def read_energy_csv(spark: SparkSession, path: str) -> DataFrame:
    """S12 energy variant: ``is_flagged`` text -> boolean."""
    raw = spark.read.schema(ENERGY_WIDE_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path)
    flag = F.lower(F.trim("is_flagged")).isin("true", "t", "1", "yes")
    return raw.withColumn("full_date", F.col("full_date").try_cast("date")).withColumn("is_flagged", flag)


def export_wide(wide: DataFrame, path: str, ordered: bool = False) -> None:
    """Gz CSV.  Empty input is refused (one-row probe).  ``ordered`` sorts globally, over as many
    files as the sort has ranges; their names are in order."""
    if wide.isEmpty():
        raise EmptyExportError("no delay facts to export")
    out = wide.orderBy("date_key", "trip_id", "stop_sequence") if ordered else wide
    out.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def export_energy(energy: DataFrame, path: str) -> bool:
    """Gz CSV of the energy scores; returns False (a warning, not an error) when empty."""
    if energy.isEmpty():
        return False
    energy.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
    return True


def load_star(spark: SparkSession, warehouse: str, start_key: int | None = None, end_key: int | None = None):
    """The materialised star for the dashboard queries: facts pruned by date_key partitions, the
    merged dimensions, and the fixed vehicle-type seed (route/stop sizes left to AQE)."""
    from adherence.operators.dims import vehicle_type_dim
    from adherence.sources.driver import Star

    return Star(
        facts=read_star(spark, f"{warehouse}/fact_trip_delay", start_key, end_key),
        routes=read_dim(spark, f"{warehouse}/dim_route"),
        stops=read_dim(spark, f"{warehouse}/dim_stop"),
        vehicle_types=vehicle_type_dim(spark),
    )


def load_rollup(spark: SparkSession, warehouse: str, start_key: int | None = None, end_key: int | None = None):
    """The roll-up that the loads keep, for the dashboard's questions (``operators.rollup``)."""
    from adherence.operators.rollup import Rollup

    star = load_star(spark, warehouse, start_key, end_key)
    delays, trips = (read_star(spark, f"{warehouse}/{t}", start_key, end_key) for t in (HISTOGRAM_TABLE, TRIPS_TABLE))
    return Rollup(delays, trips, star.routes, star.stops, star.vehicle_types)


def star_from_wide(wide: DataFrame):
    """The star seen through the wide exchange format (S12 input for the same delay queries):
    stable hash keys for routes and stops, dimension tables as distinct rows of the wide frame
    (reduced map-side), the vehicle-type key from the fixed seed by name."""
    from adherence.functions.ids import stable_key
    from adherence.operators.dims import vehicle_type_dim
    from adherence.sources.driver import Star

    vt = vehicle_type_dim(wide.sparkSession)
    w = wide.withColumns({"route_key": stable_key("route_id"), "stop_key": stable_key("stop_id")})
    w = w.join(F.broadcast(vt.select("type_name", "vehicle_type_key")), "type_name", "left")  # 8-row seed
    facts = w.select("date_key", "full_date", "route_key", "stop_key", "vehicle_type_key", "trip_id",
                     "stop_sequence", "scheduled_arrival", "actual_arrival", "delay_seconds", "data_source")
    routes = w.select("route_key", "route_id", "route_short_name", "route_long_name").dropDuplicates(["route_key"])
    stops = w.select("stop_key", "stop_id", "stop_name", "stop_lat", "stop_lon").dropDuplicates(["stop_key"])
    return Star(facts=facts, routes=routes, stops=stops, vehicle_types=vt)
