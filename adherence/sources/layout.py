"""Tables laid out by trip (J3, W1, W3): bucketed, so that what works on trips moves no rows.

stop_times, trips and the raw facts are hashed by trip and sorted once, when they are stored.  The join of
stop times and trips, the first stop of each trip and the de-duplication by a grain that contains the trip
then run inside the buckets: their plans have no exchange.  The table is known to the session's catalog
under a name; its files lie under a path of the caller's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def store_by_trip(df: DataFrame, name: str, path: str, buckets: int, sort: tuple[str, ...] = (), trip: str = "trip_id") -> DataFrame:
    """``df`` as a table of ``buckets`` buckets by trip, each one file sorted by trip and ``sort``; read back.
    Tables that are to meet without an exchange need the same number; a bucket is what one task takes."""
    hashed = df.repartition(buckets, trip)  # a task writes one bucket, so a bucket is one file
    (hashed.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, trip).sortBy(trip, *sort).saveAsTable(name))
    return df.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, schema: str, buckets: int, sort: tuple[str, ...] = (), trip: str = "trip_id") -> DataFrame:
    """A stored table in a session whose catalog doesn't know it."""
    order = ", ".join([trip, *sort])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({trip}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
