"""What the operators share: reading tables, storing intermediate frames on the shared folder,
and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.session import ensure_checkpoint_dir

#: Rows of one bigint that a checked broadcast may hold (16 MB of ids); beyond it the join is shuffled.
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the data folder, with the named columns only."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``); only a local session without one gets a
    folder beside its warehouse."""
    return ensure_checkpoint_dir(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage ends there, and a lost
    executor loses nothing that later steps need."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (a stored frame of distinct bigints).  The ids are
    broadcast if their count, which is taken first, is below ``BROADCAST_IDS``; else both sides shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id of ``edges`` (a, b bigints, any direction): comp is the least id reachable.

    Alternating large-star and small-star steps: each links neighbours to the least one it knows, so
    the number of rounds grows with the logarithm of a component's size.  A vertex with very many
    neighbours is reduced by ``min`` before its rows move; no task holds a component."""
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: every larger neighbour of a points at the least of a's neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: every smaller neighbour, and a itself, points at the least smaller neighbour
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.*").where("a <> b").distinct())
        e = stored(small, "edges")
        # done when every edge leads to a root: no target of an edge is itself a source, and no source has two
        many = e.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        if not many and not e.select(F.col("b").alias("a")).join(e.select("a"), "a", "left_semi").limit(1).count():
            break
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
