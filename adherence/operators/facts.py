"""Fact build (J15, J16, W3, L10, Q10): matched rows -> ``fact_trip_delay`` rows + a load report.

* J15: natural keys are looked up in the dimensions with left joins; rows without a route or stop
  key are set aside and counted (never silently dropped from the report).
* W3 / D8: duplicates of the grain (trip_id, stop_key, date_key, stop_sequence) collapse to one row
  under a total order (realtime stop_sequence equal to the schedule's first, then the latest
  snapshot, then the latest actual time, then the remaining columns).  The collapse is an aggregate
  (``max_by`` of a struct) whose map side already shrinks a hot grain before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.constants import FACT_DATA_SOURCE
from adherence.functions import gtfs_time as T
from adherence.operators.dims import join_dim, lookup_vehicle_type
from adherence.operators.quality import GRAIN, load_report, reject_reason

FACT_COLUMNS = ["date_key", "full_date", "route_key", "stop_key", "vehicle_type_key", "trip_id", "stop_sequence",
                "scheduled_arrival", "actual_arrival", "delay_seconds", "data_source"]


def with_keys(matched: DataFrame, routes: DataFrame, stops: DataFrame, vehicle_types: DataFrame,
              operator: str | None = None) -> DataFrame:
    """J15 + J16: surrogate keys by natural key; ``has_dim`` marks rows that can be loaded.  The same
    natural key may stand for several operators: ``operator`` names whose dimension rows are meant."""
    if operator is not None:
        routes, stops = (d.filter(F.col("operator") == operator) for d in (routes, stops))
    r = routes.select("route_id", "route_key")
    s = stops.select("stop_id", "stop_key")
    out = join_dim(matched, r, "route_id", how="left")
    out = join_dim(out, s, "stop_id", how="left")
    out = lookup_vehicle_type(out, vehicle_types, F.col("route_type"))
    return out.withColumn("has_dim", F.col("route_key").isNotNull() & F.col("stop_key").isNotNull())


def dedupe(rows: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """One row per grain under the D8 total order."""
    same_seq = (F.col("rt_stop_sequence").cast("string") == F.col("stop_sequence").cast("string")) \
        if "rt_stop_sequence" in rows.columns else F.lit(True)
    snap = F.col("snapshot_ts") if "snapshot_ts" in rows.columns else F.lit(None).cast("timestamp_ntz")
    order = F.struct(F.coalesce(same_seq, F.lit(False)).alias("o1"), snap.alias("o2"),
                     F.col("actual_epoch").alias("o3"), F.col("delay_seconds").alias("o4"),
                     F.col("vehicle_type_key").alias("o5"), F.col("route_key").alias("o6"),
                     F.col("scheduled_arrival").alias("o7"))
    payload = [c for c in FACT_COLUMNS if c not in grain]
    return rows.groupBy(*grain).agg(F.max_by(F.struct(*payload), order).alias("_w")).select(*grain, "_w.*")


def build(derived: DataFrame, routes: DataFrame, stops: DataFrame, vehicle_types: DataFrame,
          quarantine_out_of_range: bool = False, operator: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matched + derived rows -> (facts, load report, rejects).  ``derived`` carries service_date,
    scheduled_arrival, actual_arrival and delay_seconds (see ``match.derive``).

    Rows breaking the fact table's NOT NULL contract (no trip id, unparsable scheduled time, D12)
    go to the rejects with a reason instead of failing the load; out-of-range delays stay in the
    facts (a WARN check) unless ``quarantine_out_of_range`` sends them to the rejects too (Q10)."""
    keyed = with_keys(derived, routes, stops, vehicle_types, operator)
    keyed = keyed.withColumns({
        "date_key": T.date_key("service_date"),
        "full_date": F.col("service_date").cast("date"),
        "stop_sequence": F.col("stop_sequence").try_cast("int"),
        "data_source": F.lit(FACT_DATA_SOURCE),
    })
    reason = reject_reason(keyed.columns)
    if not quarantine_out_of_range:
        reason = F.when(reason != "delay_out_of_range", reason)
    keyed = keyed.withColumn("reject_reason", F.when(F.col("has_dim"), reason))
    report = load_report(keyed)
    rejected = keyed.filter(F.col("reject_reason").isNotNull())
    facts = dedupe(keyed.filter(F.col("has_dim") & F.col("reject_reason").isNull()))
    return facts.select(*FACT_COLUMNS), report, rejected.select(*FACT_COLUMNS, "reject_reason")
