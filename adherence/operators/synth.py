"""Synthetic delay facts for demos and tests (days x 40 trips x 6 stops).

Generated with ``spark.range`` and ``explode(sequence)``; the delay is a seeded gaussian clipped
to [-600, 3600] seconds.  Never registered as a query: it reads no input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.functions import gtfs_time as T


def synthetic_facts(spark: SparkSession, start: str, days: int, trips_per_day: int = 40, stops_per_trip: int = 6,
                    seed: int = 42) -> DataFrame:
    """``days`` x ``trips_per_day`` x ``stops_per_trip`` fact rows with clipped gaussian delays."""
    base = spark.range(days * trips_per_day).select(
        (F.col("id") / trips_per_day).cast("int").alias("day"), (F.col("id") % trips_per_day).alias("trip"))
    rows = base.select("*", F.explode(F.sequence(F.lit(1), F.lit(stops_per_trip))).alias("stop_sequence"))
    d = F.date_add(F.lit(start).cast("date"), F.col("day"))
    sched = T.local_datetime(d, (F.lit(6 * 3600) + F.col("trip") * 1200 + F.col("stop_sequence") * 180).cast("int"))
    delay = F.least(F.greatest(F.lit(120.0) + F.lit(180.0) * F.randn(seed), F.lit(-600.0)), F.lit(3600.0)).cast("int")
    return rows.select(
        T.date_key(d).alias("date_key"), d.alias("full_date"),
        (F.col("trip") % 8).alias("route_key"), (F.col("stop_sequence") + F.col("trip") % 5).cast("long").alias("stop_key"),
        F.lit(4).alias("vehicle_type_key"),
        F.concat_ws("_", F.lit("T"), F.col("day"), F.col("trip")).alias("trip_id"), "stop_sequence",
        sched.alias("scheduled_arrival"), delay.alias("delay_seconds"),
    ).withColumn("actual_arrival", F.timestamp_add("SECOND", F.col("delay_seconds"), F.col("scheduled_arrival"))) \
     .withColumn("data_source", F.lit("synthetic"))
