"""Spark session helpers.

The library never builds its own cluster configuration: jobs run inside whatever
session the caller (spark-submit, a notebook, the tests) provides.  ``local_session``
exists for tests and the bench only.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a partition, about, where the number of partitions follows the number of rows.
TASK_ROWS = 500_000
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # registered queries compare wall-clock NTZ values; epochs are zone-explicit anyway
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "adherence") -> SparkSession:
    """A local session for tests and the bench (never used by library code)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ADHERENCE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is respected as-is; if it is missing
    there, this fails rather than invent a machine-local folder.  A local master (tests, bench) gets a
    folder in its warehouse.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name shared storage on a cluster")
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its Hadoop filesystem (HDFS, S3A, local)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read again: it is computed once, survives
    lost executors, and later filters and column choices reach its files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` into as many partitions as keep one at ``TASK_ROWS`` rows or so, so that what a
    task sorts and aggregates doesn't grow with the input; up to that many rows Spark chooses."""
    if rows <= TASK_ROWS:
        return df.repartition(*keys)
    return df.repartition(max(-(-rows // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism), *keys)
