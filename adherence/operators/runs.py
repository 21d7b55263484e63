"""Pipeline run log (L6, L7, W4): append-only events, current state by a window per date."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN_SCHEMA = ("run_id string, dag_run_id string, service_date date, started_at timestamp, "
              "finished_at timestamp, status string, rows_ingested long, rows_fact long, dq_status string")


def run_record(spark: SparkSession, service_date: str, status: str, rows_fact: int, dag_run_id: str | None = None,
               started_at: dt.datetime | None = None, finished_at: dt.datetime | None = None) -> DataFrame:
    """One run row (the job's own bookkeeping, a single row by construction)."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (str(uuid.uuid4()), dag_run_id, dt.date.fromisoformat(service_date), started_at or now,
           finished_at or now, status, None, int(rows_fact), None)
    return spark.createDataFrame([row], RUN_SCHEMA)


def dq_event(spark: SparkSession, service_date: str, dq_status: str, dag_run_id: str | None = None) -> DataFrame:
    """A data-quality status event; the current status is derived, never updated in place."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (None, dag_run_id, dt.date.fromisoformat(service_date), None, now, None, None, None, dq_status)
    return spark.createDataFrame([row], RUN_SCHEMA)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("service_date").parquet(path)


def latest(runs: DataFrame) -> DataFrame:
    """The latest run per service date by finished_at DESC NULLS LAST, with its most recent
    dq_status event: matched on dag_run_id, else the date's latest event that names no logged run.

    The window is per service date; a date holds a handful of run rows."""
    w = Window.partitionBy("service_date").orderBy(F.col("finished_at").desc_nulls_last(), F.col("run_id").desc())
    run_rows = runs.filter(F.col("run_id").isNotNull())
    last_run = run_rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "dq_status")
    ev = runs.filter(F.col("dq_status").isNotNull())
    by_run = ev.filter(F.col("dag_run_id").isNotNull()).groupBy("service_date", "dag_run_id").agg(
        F.max_by("dq_status", "finished_at").alias("dq_by_run"))
    # the date's latest event counts only if it names no run, or none that is logged
    loose = ev.join(run_rows.select("service_date", "dag_run_id"), ["service_date", "dag_run_id"], "left_anti")
    by_date = loose.groupBy("service_date").agg(F.max_by("dq_status", "finished_at").alias("dq_by_date"))
    out = last_run.join(by_run, ["service_date", "dag_run_id"], "left").join(by_date, "service_date", "left")
    return out.withColumn("dq_status", F.coalesce("dq_by_run", "dq_by_date")).drop("dq_by_run", "dq_by_date")
