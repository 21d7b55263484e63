"""Roll-up of the facts that the delay questions are answered from.

``delays`` is a histogram of whole-second delays: for each (date, route, vehicle type, stop, hour of the
scheduled arrival) how many arrivals had which delay, NULL among them.  Counts add up, so histograms of
several loads or dates merge by a sum, and from a merged one follow counts, means, shares and exact
percentiles.  ``trips`` has each trip of a date once, as trips seen can't be added up over dates.  Both are
kept by the load, per date, beside the facts (``jobs.run_transform``), and change with them.

The answers are those of ``operators.delays`` over the facts, value for value: sums of whole numbers below
2^53 are exact, and a percentile over values with frequencies is the one over the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adherence.constants import (
    LADDER_MINUTES,
    LATE_THRESHOLD_SEC,
    ROUTE_MIN_OBSERVATIONS,
    STOP_MIN_OBSERVATIONS,
    VERY_LATE_THRESHOLD_SEC,
)
from adherence.functions import gtfs_time as T
from adherence.operators import delays as A
from adherence.operators.filters import ALL, Filters

CELL = ["date_key", "full_date", "route_key", "vehicle_type_key", "stop_key", "hour_of_day"]
TRIP = ["date_key", "full_date", "route_key", "vehicle_type_key", "trip_id"]


@dataclass
class Rollup:
    """Both parts of the roll-up and the dimensions of its keys."""

    delays: DataFrame
    trips: DataFrame
    routes: DataFrame
    stops: DataFrame
    vehicle_types: DataFrame

    def over(self, rows: DataFrame):
        """A star whose facts are rows of the roll-up."""
        from adherence.sources.driver import Star

        return Star(rows, self.routes, self.stops, self.vehicle_types)


def delay_histogram(facts: DataFrame) -> DataFrame:
    """Rows (cell, delay_seconds, n); map-side combined, one exchange."""
    hour = T.hour_of("scheduled_arrival").alias("hour_of_day")
    return facts.groupBy(*CELL[:-1], hour, "delay_seconds").agg(F.count(F.lit(1)).alias("n"))


def trip_days(facts: DataFrame) -> DataFrame:
    """Each trip of a date once."""
    return facts.where(F.col("trip_id").isNotNull()).select(*TRIP).distinct()


def merge_histograms(*parts: DataFrame) -> DataFrame:
    """One histogram of several."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*CELL, "delay_seconds").agg(F.sum("n").alias("n"))


def build(star) -> Rollup:
    """The roll-up of a star's facts."""
    return Rollup(delay_histogram(star.facts), trip_days(star.facts), star.routes, star.stops, star.vehicle_types)


def _view(r: Rollup, filters: Filters, **parts) -> DataFrame:
    return A.delay_view(r.over(r.delays), filters, **parts)


def _rows(cond: Column | None = None) -> Column:
    """Arrivals (for which ``cond`` holds); 0 without any."""
    n = F.col("n") if cond is None else F.when(cond, F.col("n"))
    return F.coalesce(F.sum(n), F.lit(0)).cast("bigint")


def _mean() -> Column:
    measured = F.sum(F.when(F.col("delay_seconds").isNotNull(), F.col("n")))
    return F.try_divide(F.sum(F.col("delay_seconds").cast("bigint") * F.col("n")).cast("double"), measured.cast("double"))


def _share(cond: Column) -> Column:
    """Share of measured arrivals."""
    return F.try_divide(_rows(cond).cast("double"), F.sum(F.when(F.col("delay_seconds").isNotNull(), F.col("n"))).cast("double"))


def _median(value="delay_seconds", p: float = 0.5) -> Column:
    return F.percentile(value, p, F.col("n"))


def kpis(r: Rollup, filters: Filters = ALL) -> DataFrame:
    """A1."""
    d = F.col("delay_seconds")
    trips = A.delay_view(r.over(r.trips), filters).agg(F.countDistinct("trip_id").alias("n")).scalar()
    out = _view(r, filters).agg(_rows().alias("total_facts"), _median().alias("median_delay_sec"), _share(d <= 0).alias("on_time_rate"),
                                _rows(d.isNotNull()).alias("observed_delay_count"))
    rate = F.when(F.col("total_facts") > 0, F.col("observed_delay_count") / F.col("total_facts"))
    return out.select("total_facts", trips.alias("trips_observed"), "median_delay_sec", "on_time_rate", "observed_delay_count", rate.alias("realtime_match_rate"))


def _by_route(r: Rollup, filters: Filters) -> DataFrame:
    d = F.col("delay_seconds")
    return _view(r, filters, route=True, measured=True).groupBy("route_short_name").agg(
        _rows().alias("n_observations"), _mean().alias("avg_delay_sec"), _median().alias("median_delay_sec"),
        _share(d > LATE_THRESHOLD_SEC).alias("pct_late"), _share(d > VERY_LATE_THRESHOLD_SEC).alias("pct_very_late"))


def avg_delay_by_route(r: Rollup, filters: Filters = ALL, limit: int = 20) -> DataFrame:
    """A4 (A3 is its first row)."""
    rows = _by_route(r, filters).select("route_short_name", "avg_delay_sec", "n_observations")
    return A.top_k(rows, limit, F.col("avg_delay_sec").desc(), F.col("route_short_name").asc_nulls_last())


def route_lateness(r: Rollup, filters: Filters = ALL, *, min_observations: int = ROUTE_MIN_OBSERVATIONS, limit: int = 25) -> DataFrame:
    """A5."""
    return A.top_k(_by_route(r, filters).where(F.col("n_observations") >= min_observations), limit,
                   F.col("pct_late").desc(), F.col("avg_delay_sec").desc(), F.col("route_short_name").asc_nulls_last())


def delay_heatmap(r: Rollup, filters: Filters = ALL) -> DataFrame:
    """A6; W5, A16 and A18 take it as they take that of the facts."""
    return _view(r, filters, date_attrs=True, measured=True).groupBy("day_name", "day_of_week", "hour_of_day").agg(_mean().alias("avg_delay_sec"))


def worst_stops(r: Rollup, filters: Filters = ALL, limit: int = 10, min_observations: int = STOP_MIN_OBSERVATIONS) -> DataFrame:
    """A7."""
    rows = _view(r, filters, stop=True, measured=True).groupBy("stop_name", "stop_id").agg(_mean().alias("avg_delay_sec"), _rows().alias("n_observations"))
    return A.top_k(rows.where(F.col("n_observations") >= min_observations), limit, F.col("avg_delay_sec").desc(), F.col("stop_id").asc())


def stops_map(r: Rollup, filters: Filters = ALL) -> DataFrame:
    """A8; P12 and A13 take it as they take that of the facts."""
    rows = _view(r, filters, stop=True, measured=True).where(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull())
    return rows.groupBy("stop_name", "stop_lat", "stop_lon").agg(_mean().alias("avg_delay_sec"), _rows().alias("n_observations"))


def punctuality_summary(r: Rollup, filters: Filters = ALL) -> DataFrame:
    """A10 + A11; A12 takes it as it takes that of the facts."""
    minutes = (F.col("delay_seconds") / 60.0).cast("double")
    percent = lambda cond: F.try_divide(F.lit(100.0) * _rows(cond), _rows()).cast("double")
    return _view(r, filters, measured=True).agg(
        _rows().alias("n"), percent(minutes < -1).alias("early_pct"), percent(minutes.between(-1, 1)).alias("on_time_pct"), percent(minutes > 1).alias("late_pct"),
        *[percent(F.abs(minutes) <= k).alias(f"within_{k}_pct") for k in LADDER_MINUTES],
        _median(minutes).alias("median_min"), _median(minutes, 0.9).alias("p90_min"))
