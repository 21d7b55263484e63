"""Data-quality gate (Q1-Q10, J17) for the fact table, per service date.

L9: the constraints a database would enforce (NOT NULL, the UNIQUE grain, foreign keys) are not
available on Parquet; they are checked here (DQ-002, DQ-006, DQ-005) and enforced at load time
by ``facts.build`` (NOT NULL violations go to the rejects, the grain is de-duplicated, rows
without dimension keys are counted and skipped).

All checks of a fact table come out of one pass (``profile``): an aggregate over two grouping sets whose
first level combines map-side.  Only the small per-date report ever reaches the driver (``gate``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adherence.constants import (
    DELAY_LOWER_BOUND_SEC,
    DELAY_UPPER_BOUND_SEC,
    MAX_NULL_DELAY_RATE,
    MAX_STATIC_AGE_DAYS,
)
from adherence.operators.dims import join_dim

ERROR, WARN = "ERROR", "WARN"
GRAIN = ["trip_id", "stop_key", "date_key", "stop_sequence"]
SEVERITY_RANK = {"passed": 0, "warn": 1, "failed": 2}


class DataQualityError(Exception):
    """Raised when one or more ERROR-severity checks fail."""


def _out_of_range(delay: Column) -> Column:
    return delay.isNotNull() & ((delay < DELAY_LOWER_BOUND_SEC) | (delay > DELAY_UPPER_BOUND_SEC))


def fact_stats(facts: DataFrame) -> DataFrame:
    """Q1-Q4 statistics per date_key in one pass."""
    d = F.col("delay_seconds")
    return facts.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("trip_id").isNull()).alias("null_trip_ids"),
        F.count_if(_out_of_range(d)).alias("out_of_range"),
        F.count_if(d.isNull()).alias("null_delays"),
    )


def duplicate_grain(facts: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """Q6: per date, sum(count) - number of grain groups = surplus rows."""
    per_key = facts.groupBy(*grain).agg(F.count(F.lit(1)).alias("cnt"))
    return per_key.groupBy("date_key").agg(F.sum(F.col("cnt") - 1).cast("bigint").alias("dup_count"))


def referential(facts: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows whose foreign key has no dimension row, per dimension.

    ``dims`` maps a label to (dimension frame, key column).  The facts are aggregated once into the rows of
    each key of each dimension (not of their combinations), which shrinks map-side to the keys; every
    dimension test is a left-anti join of that aggregate, whose exchange Spark reuses across the branches, so
    fact rows are read once."""
    keys = sorted({key for _, key in dims.values()})
    counts = facts.select(*keys).groupingSets([[k] for k in keys], *keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(k).alias(f"_not_{k}") for k in keys])
    out = None
    for label, (dim, key) in dims.items():
        missing = join_dim(counts.where(F.col(f"_not_{key}") == 0).select(key, "_n"), dim.select(key).distinct(), key, "left_anti")
        n = missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        n = n.select(F.lit(label).alias("dimension"), "orphan_rows")
        out = n if out is None else out.unionByName(n)
    return out


def profile(facts: DataFrame, dims: dict[str, tuple[DataFrame, str]], grain: list[str] = GRAIN, copies: str | None = None) -> DataFrame:
    """Everything DQ-001 to DQ-006 need of each date, from one pass over the facts: row_count,
    null_trip_ids, out_of_range, null_delays, orphan_rows and dup_count.

    One aggregate over two grouping sets, combined map-side: the rows of each (date, foreign keys), which
    the statistics and the referential tests come from, and of each grain.  The dimensions then mark key
    combinations, not facts, and a second aggregate per date ends it; the plan has one branch, so the facts
    are read once.  ``copies`` names a column that says how many source rows stand behind a fact, where a
    de-duplication has counted them."""
    keys = sorted({key for _, key in dims.values()})
    d = F.col("delay_seconds")
    rows = facts.withColumns({"_bad": _out_of_range(d), "_no_trip": F.col("trip_id").isNull(), "_no_delay": d.isNull(),
                              "_copies": F.col(copies) if copies else F.lit(1)})
    # the grouping sets take columns of their own, so that a key may be in both
    rows = rows.select("date_key", *[F.col(k).alias(f"k_{k}") for k in keys], *[F.col(c).alias(f"g_{c}") for c in grain if c != "date_key"],
                       "_bad", "_no_trip", "_no_delay", "_copies")
    of_keys, of_grain = [["date_key", *[c for c in rows.columns if c.startswith(p)]] for p in ("k_", "g_")]
    one = rows.groupingSets([of_keys, of_grain], "date_key", *of_keys[1:], *of_grain[1:]).agg(
        F.grouping(of_grain[1]).alias("by_keys"), F.count(F.lit(1)).alias("n"), F.sum("_copies").alias("copies"), F.count_if("_no_trip").alias("no_trip"),
        F.count_if("_bad").alias("bad"), F.count_if("_no_delay").alias("no_delay"))
    by_keys = F.col("by_keys") == 1
    missing = F.lit(0)
    for label, (dim, key) in dims.items():
        there = dim.select(F.col(key).alias(f"k_{key}"), F.lit(1).alias(f"_{label}")).distinct()
        one = one.join(there, f"k_{key}", "left")
        missing = missing + F.when(by_keys & F.col(f"_{label}").isNull(), 1).otherwise(0)
    total = lambda c: F.coalesce(F.sum(F.when(by_keys, c)), F.lit(0)).cast("bigint")
    return one.groupBy("date_key").agg(
        total(F.col("n")).alias("row_count"), total(F.col("no_trip")).alias("null_trip_ids"), total(F.col("bad")).alias("out_of_range"),
        total(F.col("no_delay")).alias("null_delays"), total(F.col("n") * missing).alias("orphan_rows"),
        F.coalesce(F.sum(F.when(~by_keys, F.col("copies") - 1)), F.lit(0)).cast("bigint").alias("dup_count"))


def report(stats: DataFrame, dups: DataFrame, orphans_by_date: DataFrame | None = None,
           static_age_days: Column | None = None) -> DataFrame:
    """Q1-Q7 from frames of their own for the statistics, the duplicates and the orphans."""
    s = stats.join(dups, "date_key", "left")
    if orphans_by_date is not None:
        s = s.join(orphans_by_date, "date_key", "left")
    else:
        s = s.withColumn("orphan_rows", F.lit(0).cast("bigint"))
    return report_of(s, static_age_days)


def report_of(s: DataFrame, static_age_days: Column | None = None) -> DataFrame:
    """Q1-Q7 (and L9's constraints) as rows (date_key, check_id, severity, passed, observed), from one row a
    date as ``profile`` gives it.

    ``static_age_days`` is the age of the static feed against an injected ``as_of`` time (S9);
    unknown age fails DQ-007, as in the source system.
    """
    total = F.col("row_count")
    null_rate = F.when(total > 0, F.col("null_delays") / total).otherwise(F.lit(0.0))
    age = static_age_days if static_age_days is not None else F.lit(None).cast("double")
    checks = [
        ("DQ-001", ERROR, total > 0, total.cast("double")),
        ("DQ-002", ERROR, F.col("null_trip_ids") == 0, F.col("null_trip_ids").cast("double")),
        ("DQ-003", WARN, F.col("out_of_range") == 0, F.col("out_of_range").cast("double")),
        ("DQ-004", WARN, null_rate < MAX_NULL_DELAY_RATE, null_rate.cast("double")),
        ("DQ-005", ERROR, F.coalesce(F.col("orphan_rows"), F.lit(0)) == 0,
         F.coalesce(F.col("orphan_rows"), F.lit(0)).cast("double")),
        ("DQ-006", ERROR, F.coalesce(F.col("dup_count"), F.lit(0)) == 0,
         F.coalesce(F.col("dup_count"), F.lit(0)).cast("double")),
        ("DQ-007", WARN, F.coalesce(age < MAX_STATIC_AGE_DAYS, F.lit(False)), age),
    ]
    arr = F.array(*[
        F.struct(F.lit(cid).alias("check_id"), F.lit(sev).alias("severity"),
                 F.coalesce(ok, F.lit(False)).alias("passed"), obs.alias("observed"))
        for cid, sev, ok, obs in checks
    ])
    return s.select("date_key", F.inline(arr))


def status(rep: DataFrame) -> DataFrame:
    """Q8: failed if an ERROR check fails, else warn if a WARN check fails, else passed."""
    rank = F.when(~F.col("passed") & (F.col("severity") == ERROR), 2).when(~F.col("passed"), 1).otherwise(0)
    r = rep.groupBy("date_key").agg(F.max(rank).alias("r"))
    return r.select("date_key", F.when(F.col("r") == 2, "failed").when(F.col("r") == 1, "warn")
                    .otherwise("passed").alias("dq_status"))


def gate(rep: DataFrame) -> None:
    """Q9: raise listing every failed ERROR check: its dates (how many, first and last) and its worst
    value.  One row a check comes back, seven at most."""
    failed = rep.filter(~F.col("passed") & (F.col("severity") == ERROR)).groupBy("check_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("date_key").alias("lo"), F.max("date_key").alias("hi"), F.max("observed").alias("worst"))
    rows = sorted(failed.collect())
    if rows:
        dates = lambda r: f"date {r.lo}" if r.lo == r.hi else f"{r.n} dates, {r.lo} to {r.hi}"
        summary = "; ".join(f"[{r.check_id}] {dates(r)}: {r.worst}" for r in rows)
        raise DataQualityError(f"{sum(r.n for r in rows)} data quality check(s) failed: {summary}")


def reject_reason(columns: list[str]) -> Column:
    """Q10: why a row is set aside, in priority order; NULL if it isn't."""
    reason = F.when(F.col("trip_id").isNull(), "null_trip_id").when(
        F.col("scheduled_arrival").isNull(), "null_scheduled_arrival")
    if "stop_sequence" in columns:
        reason = reason.when(F.col("stop_sequence").isNull(), "null_stop_sequence")
    return reason.when(_out_of_range(F.col("delay_seconds")), "delay_out_of_range")


def split_rejects(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q10: (accepted, rejected-with-reason)."""
    tagged = facts.withColumn("reject_reason", reject_reason(facts.columns))
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))


def orphan_rows_by_date(facts: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """DQ-005 per date: fact rows whose key is missing from a dimension (summed over dims), from
    one aggregate of the facts by (date_key, keys)."""
    keys = sorted({key for _, key in dims.values()})
    combos = facts.groupBy("date_key", *keys).agg(F.count(F.lit(1)).alias("_n"))
    out = None
    for _, (dim, key) in dims.items():
        n = combos.join(dim.select(key).distinct(), on=key, how="left_anti").groupBy("date_key").agg(
            F.sum("_n").alias("orphan_rows"))
        out = n if out is None else out.unionByName(n)
    return out.groupBy("date_key").agg(F.sum("orphan_rows").cast("bigint").alias("orphan_rows"))


def load_report(candidates: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """Rows seen, loaded, skipped without a dimension key, duplicates collapsed.

    ``candidates`` carries a boolean ``has_dim``, and a ``reject_reason`` where rejects were set aside:
    those are counted as ``rows_rejected`` and not as loaded.  First level groups by the grain (map-side
    combine), second level is a global sum, so no grain group is ever materialised whole."""
    split = "reject_reason" in candidates.columns
    state = F.when(F.col("reject_reason").isNotNull(), "rejected") if split else F.lit(None).cast("string")
    state = F.coalesce(state, F.when(F.col("has_dim"), "loaded").otherwise("no_dim"))
    g = candidates.groupBy(*grain, state.alias("_state")).agg(F.count(F.lit(1)).alias("cnt"))

    def total(which: str, value) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_state") == which, value)), F.lit(0)).cast("bigint")

    return g.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("rows_seen"),
        total("loaded", F.lit(1)).alias("rows_loaded"),
        total("no_dim", F.col("cnt")).alias("skipped_no_dim"),
        *([total("rejected", F.col("cnt")).alias("rows_rejected")] if split else []),
        total("loaded", F.col("cnt") - 1).alias("duplicates_collapsed"),
    )
