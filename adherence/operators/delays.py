"""Delay questions over the star.

Each function is ``(Star, Filters, ...) -> DataFrame`` and lazy.  Dimensions are joined only
when a column or a filter needs them (the facts carry enforced foreign keys, see ``quality``),
the date predicate is applied on the fact's ``date_key`` first so it prunes partitions, and
every ranking carries a unique tie-break so top-k results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adherence.constants import (
    EMPTY_COLOR_RANGE,
    LADDER_MINUTES,
    LATE_THRESHOLD_SEC,
    MAP_MIN_OBSERVATIONS,
    ROUTE_MIN_OBSERVATIONS,
    STOP_MIN_OBSERVATIONS,
    VERY_LATE_THRESHOLD_SEC,
    VEHICLE_TYPES,
)
from adherence.functions import gtfs_time as T
from adherence.functions.ids import uniform
from adherence.functions.numeric import display_round, py_format, py_signed
from adherence.operators.dims import join_dim
from adherence.operators.filters import ALL, Filters



def median(c: Column, approx: bool = False) -> Column:
    """Exact median (linear interpolation, as PERCENTILE_CONT) or, as an option, the approximate
    percentile whose memory per group is bounded by its accuracy rather than by distinct values."""
    return F.percentile_approx(c, 0.5, 10000) if approx else F.percentile(c, 0.5)


def _pct(cond: Column) -> Column:
    """avg of a 1.0/0.0 indicator as DOUBLE (a bare 1.0 literal would be DECIMAL in Spark)."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)).cast("double"))


def delay_view(star, filters: Filters = ALL, *, route: bool = False, stop: bool = False,
               vehicle: bool = False, date_attrs: bool = False, measured: bool = False) -> DataFrame:
    """Facts joined to the dimensions the caller needs, filtered."""
    f = star.facts.filter(filters.date_predicate())
    if measured:
        f = f.filter(F.col("delay_seconds").isNotNull())
    if route or filters.needs_routes():
        f = join_dim(f, star.routes, "route_key")
    if vehicle or filters.needs_vehicle_types():
        f = join_dim(f, star.vehicle_types, "vehicle_type_key")
    if stop:
        f = join_dim(f, star.stops, "stop_key")
    if date_attrs:
        # dim_date covers every service date, so its attributes are computed in place
        f = f.withColumns({"day_name": T.day_name("full_date"), "day_of_week": T.iso_day_of_week("full_date")})
    if filters.needs_routes() or filters.needs_vehicle_types():
        f = f.filter(filters.predicate())
    return f


def top_k(df: DataFrame, k: int, *order: Column, rank_col: str | None = "rank") -> DataFrame:
    """Ordered top-k (TakeOrderedAndProject), with an optional 1-based rank column.

    The rank window runs over at most ``k`` rows (after the limit), never over the data."""
    out = df.orderBy(*order).limit(k)
    if rank_col:
        out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    return out


# ---------------------------------------------------------------------------- A1-A3


def kpis(star, filters: Filters = ALL, approx: bool = False) -> DataFrame:
    """A1: one pass over the facts; median is exact (percentile over integer delays)."""
    f = delay_view(star, filters)
    agg = f.agg(
        F.count(F.lit(1)).alias("total_facts"),
        F.countDistinct("trip_id").alias("trips_observed"),
        median(F.col("delay_seconds"), approx).alias("median_delay_sec"),
        F.avg(F.when(F.col("delay_seconds").isNull(), None).when(F.col("delay_seconds") <= 0, 1.0).otherwise(0.0).cast("double")).alias("on_time_rate"),
        F.count(F.col("delay_seconds")).alias("observed_delay_count"),
    )
    return agg.withColumn(
        "realtime_match_rate",
        F.when(F.col("total_facts") > 0, F.col("observed_delay_count") / F.col("total_facts")),
    )


def date_range(star) -> DataFrame:
    """A2: available date range (NULLs when there are no facts)."""
    return star.facts.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))


def default_window(star) -> DataFrame:
    """The last seven days ending at the newest service date (clipped to the oldest)."""
    r = date_range(star)
    return r.select(
        F.greatest(F.col("min_date"), F.date_sub("max_date", 6)).alias("start_date"),
        F.col("max_date").alias("end_date"),
    )


def _route_avgs(star, filters: Filters) -> DataFrame:
    f = delay_view(star, filters, route=True, measured=True)
    return f.groupBy("route_short_name").agg(
        F.avg(F.col("delay_seconds")).alias("avg_delay_sec"), F.count(F.lit(1)).alias("n_observations")
    )


def worst_route(star, filters: Filters = ALL) -> DataFrame:
    """A3: the route short name with the highest average delay, ``N/A`` when none."""
    top = top_k(
        _route_avgs(star, filters), 1,
        F.col("avg_delay_sec").desc(), F.col("route_short_name").asc_nulls_last(), rank_col=None,
    )
    return top.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit("N/A")).otherwise(F.max("route_short_name")).alias("worst_route")
    )


def avg_delay_by_route(star, filters: Filters = ALL, limit: int = 20) -> DataFrame:
    """A4."""
    return top_k(
        _route_avgs(star, filters), limit,
        F.col("avg_delay_sec").desc(), F.col("route_short_name").asc_nulls_last(),
    )


def route_lateness_all(star, filters: Filters = ALL, min_observations: int = ROUTE_MIN_OBSERVATIONS,
                       approx: bool = False) -> DataFrame:
    f = delay_view(star, filters, route=True, measured=True)
    g = f.groupBy("route_short_name").agg(
        F.count(F.lit(1)).alias("n_observations"),
        F.avg(F.col("delay_seconds")).alias("avg_delay_sec"),
        median(F.col("delay_seconds"), approx).alias("median_delay_sec"),
        _pct(F.col("delay_seconds") > LATE_THRESHOLD_SEC).alias("pct_late"),
        _pct(F.col("delay_seconds") > VERY_LATE_THRESHOLD_SEC).alias("pct_very_late"),
    )
    return g.filter(F.col("n_observations") >= min_observations)


def route_lateness(star, filters: Filters = ALL, *, min_observations: int = ROUTE_MIN_OBSERVATIONS,
                   limit: int = 25, approx: bool = False) -> DataFrame:
    """A5: share of arrivals more than 60 s / 300 s late per route short name."""
    return top_k(
        route_lateness_all(star, filters, min_observations, approx), limit,
        F.col("pct_late").desc(), F.col("avg_delay_sec").desc(), F.col("route_short_name").asc_nulls_last(),
    )


def rerank_lateness(lateness: DataFrame, by: str = "avg") -> DataFrame:
    """Re-rank an already limited lateness table by average delay (or by % late)."""
    if by == "avg":
        order = [F.col("avg_delay_sec").desc(), F.col("pct_late").desc()]
    else:
        order = [F.col("pct_late").desc(), F.col("avg_delay_sec").desc()]
    order.append(F.col("route_short_name").asc_nulls_last())
    return lateness.drop("rank").withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


# ---------------------------------------------------------------------------- A6, W5, A16, A18


def delay_heatmap(star, filters: Filters = ALL) -> DataFrame:
    """Average delay by service weekday and local hour of the scheduled arrival."""
    f = delay_view(star, filters, date_attrs=True, measured=True)
    return f.groupBy("day_name", "day_of_week", T.hour_of("scheduled_arrival").alias("hour_of_day")).agg(
        F.avg(F.col("delay_seconds")).alias("avg_delay_sec")
    )


def heatmap_pivot(heatmap: DataFrame) -> DataFrame:
    """One row per day present (Mon..Sun order via ``day_of_week``), one column per hour."""
    hours = list(range(24))
    p = heatmap.groupBy("day_name", "day_of_week").pivot("hour_of_day", hours).agg(F.first("avg_delay_sec"))
    out = p.select("day_name", "day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    return out.orderBy("day_of_week")  # Mon..Sun, at most seven rows


def worst_time_slots(heatmap: DataFrame, k: int = 8) -> DataFrame:
    """Top heatmap cells by average delay."""
    return top_k(
        heatmap, k, F.col("avg_delay_sec").desc(), F.col("day_of_week").asc(), F.col("hour_of_day").asc()
    )


def days_present(heatmap: DataFrame) -> DataFrame:
    """Weekdays present in Mon..Sun order, and the number of heatmap cells."""
    ordered = F.array_sort(F.collect_set(F.struct("day_of_week", "day_name")))
    return heatmap.agg(
        F.concat_ws(",", F.transform(ordered, lambda s: s["day_name"])).alias("days"),
        F.count(F.lit(1)).alias("n_slots"),
    )


# ---------------------------------------------------------------------------- A7, A8, P12, A13


def worst_stops(star, filters: Filters = ALL, limit: int = 10, min_observations: int = STOP_MIN_OBSERVATIONS) -> DataFrame:
    """A7."""
    f = delay_view(star, filters, stop=True, measured=True)
    g = f.groupBy("stop_name", "stop_id").agg(
        F.avg(F.col("delay_seconds")).alias("avg_delay_sec"), F.count(F.lit(1)).alias("n_observations")
    ).filter(F.col("n_observations") >= min_observations)
    return top_k(g, limit, F.col("avg_delay_sec").desc(), F.col("stop_id").asc())


def stops_map(star, filters: Filters = ALL) -> DataFrame:
    """A8 (P6: coordinates present)."""
    f = delay_view(star, filters, stop=True, measured=True).filter(
        F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()
    )
    return f.groupBy("stop_name", "stop_lat", "stop_lon").agg(
        F.avg(F.col("delay_seconds")).alias("avg_delay_sec"), F.count(F.lit(1)).alias("n_observations")
    )


def stops_map_evidence(stops: DataFrame, min_observations: int = MAP_MIN_OBSERVATIONS) -> DataFrame:
    """Keep stops with enough evidence, or all of them when none has enough.

    A window over the per-stop aggregate: one row a stop and place, whatever the number of facts, and the
    facts are read once."""
    best = F.max("n_observations").over(Window.partitionBy())
    out = stops.withColumn("_best", best)
    return out.where((F.col("n_observations") >= min_observations) | (F.col("_best") < min_observations)).drop("_best")


def robust_color_range(values: DataFrame, col: str, pad: float = 0.5) -> DataFrame:
    """p5..p95 of ``col`` padded; a spread < 1 uses median +/- 5; empty -> (-5, 15).

    One exact ``percentile`` over per-stop averages: as many values as there are stops."""
    q = values.agg(F.percentile(F.col(col), [0.05, 0.5, 0.95]).alias("q"))
    lo, mid, hi = (F.col("q")[i] for i in range(3))
    empty_lo, empty_hi = EMPTY_COLOR_RANGE
    narrow = hi - lo < 1.0
    return q.select(
        F.when(lo.isNull(), F.lit(float(empty_lo))).when(narrow, mid - 5.0 - pad).otherwise(lo - pad).alias("color_min"),
        F.when(lo.isNull(), F.lit(float(empty_hi))).when(narrow, mid + 5.0 + pad).otherwise(hi + pad).alias("color_max"))


# ---------------------------------------------------------------------------- A9-A12, A17


#: Digest ranges that the sample's bound is found on.
SAMPLE_RANGES = 1 << 16


def delay_sample(star, filters: Filters = ALL, sample_limit: int = 20000) -> DataFrame:
    """A9 + T3: a deterministic sample of measured delays: the ``sample_limit`` rows with the smallest
    digest of their grain (the limit is the feature), exact for every limit.

    First the rows of each of ``SAMPLE_RANGES`` ranges of the digest are counted (map-side combined); the
    lowest ranges that hold ``sample_limit`` rows together hold the smallest ones for certain.  Only their
    rows, the limit and one range's more in all partitions together, reach the ordered limit, which would
    otherwise get the limit from each partition."""
    f = delay_view(star, filters, measured=True)
    grain = ["trip_id", "stop_key", "stop_sequence", "date_key"]
    digest = uniform(*[F.col(c).cast("string") for c in grain])
    within = F.floor(digest * SAMPLE_RANGES)
    counts = f.groupBy(within.alias("r")).agg(F.count(F.lit(1)).alias("n"))
    below = F.coalesce(F.sum("n").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    last = counts.withColumn("_below", below).where(F.col("_below") < sample_limit).agg(F.max("r").alias("r")).scalar()
    keyed = f.where(within <= last).select(digest.alias("_h"), *grain, "delay_seconds")
    return keyed.orderBy("_h", *grain).limit(sample_limit).select("delay_seconds")


def punctuality_summary(star, filters: Filters = ALL) -> DataFrame:
    """A10 + A11 (wide): over *all* measured delays in minutes (D13 fixed: no 20k subset)."""
    f = delay_view(star, filters, measured=True)
    m = (F.col("delay_seconds") / 60.0).cast("double")
    n = F.count(F.lit(1))

    def share(cond):
        return F.try_divide(F.lit(100.0) * F.count(F.when(cond, 1)), n).cast("double")

    cols = [
        n.alias("n"),
        share(m < -1).alias("early_pct"),
        share(m.between(-1, 1)).alias("on_time_pct"),
        share(m > 1).alias("late_pct"),
    ]
    cols += [share(F.abs(m) <= k).alias(f"within_{k}_pct") for k in LADDER_MINUTES]
    cols += [
        F.percentile(m, 0.5).alias("median_min"),
        F.percentile(m, 0.9).alias("p90_min"),
    ]
    return f.agg(*cols)


def punctuality_ladder(summary: DataFrame) -> DataFrame:
    """A11 long form: one row per band (unpivot of the one-row summary)."""
    ids = [f"within_{k}_pct" for k in LADDER_MINUTES]
    long = summary.select(*[F.col(c) for c in ids]).unpivot([], ids, "band", "percent")
    return long.select(
        F.regexp_extract("band", r"within_(\d+)_pct", 1).cast("int").alias("within_minutes"),
        F.col("percent").cast("double").alias("percent"),
    )


def punctuality_dominant(summary: DataFrame) -> DataFrame:
    """Dominant group (early / about on time / late; the first wins a tie)."""
    e, o, l = F.col("early_pct"), F.col("on_time_pct"), F.col("late_pct")
    dom = F.when((e >= o) & (e >= l), "early").when(o >= l, "about on time").otherwise("late")
    return summary.select("n", F.when(F.col("n") > 0, dom).alias("dominant"))


def punctuality_story(summary: DataFrame) -> DataFrame:
    """A12 sentence."""
    e, o, l = F.col("early_pct"), F.col("on_time_pct"), F.col("late_pct")
    dom = F.when((e >= o) & (e >= l), "early").when(o >= l, "about on time").otherwise("late")
    text = F.format_string(
        "%,d measured stop arrivals: %s%% on time (within a minute), %s%% early, %s%% late; the largest group is %s. "
        "The median is %s min off the plan, and nine in ten are at %s min or less.",
        # numbers formatted as Python formats them (format_string's %f would round half-up)
        F.col("n"), py_format(o, 0), py_format(e, 0), py_format(l, 0), dom,
        py_signed(F.col("median_min"), 1), py_signed(F.col("p90_min"), 1),
    )
    return summary.select(F.when(F.col("n") > 0, text).otherwise(F.lit("These filters leave no measured delays.")).alias("story"))


def fmt_minutes(seconds) -> Column:
    """``+1.5 min`` / ``-0.3 min``; NULL -> ``N/A``."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    m = s / 60.0
    sign = F.when(m >= 0, F.lit("+")).otherwise(F.lit(""))  # the dashboard's own sign rule
    return F.when(s.isNull(), F.lit("N/A")).otherwise(F.concat(sign, py_format(m, 1), F.lit(" min")))


def lateness_display(lateness: DataFrame) -> DataFrame:
    """The lateness table in display units (minutes, percent rounded to 1)."""
    return lateness.select(
        "route_short_name",
        display_round(F.col("pct_late") * 100, 1).alias("pct_late_display"),
        display_round(F.col("pct_very_late") * 100, 1).alias("pct_very_late_display"),
        (F.col("avg_delay_sec") / 60.0).alias("avg_delay_min"),
        (F.col("median_delay_sec") / 60.0).alias("median_delay_min"),
        "n_observations",
    )


# ---------------------------------------------------------------------------- A14, A15


def available_routes(star) -> DataFrame:
    """Routes that have facts.  The fact side is reduced to distinct keys first (partial
    aggregation), so the semi join never moves fact rows."""
    keys = star.facts.select("route_key").distinct()
    out = star.routes.join(keys, "route_key", "left_semi").select("route_id", "route_short_name").distinct()
    return out.orderBy(F.col("route_short_name").asc_nulls_last(), F.col("route_id").asc())  # D15


def available_vehicle_types(star) -> DataFrame:
    """A15."""
    keys = star.facts.select("vehicle_type_key").distinct()
    out = star.vehicle_types.join(keys, "vehicle_type_key", "left_semi").select("type_name").distinct()
    return out.orderBy(F.col("type_name").asc_nulls_last())
