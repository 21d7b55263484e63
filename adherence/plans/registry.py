"""Named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL).

Every query reads the driver tables of ``sf_dir`` whole (no id subsets, no row caps except where
a top-k or sample *is* the operator).  Doubles are rounded to 6 places at the edge so results
compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from adherence.operators import delays as A
from adherence.operators.filters import Filters
from adherence.plans.oracle import with_views
from adherence.sources import driver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    cols = [
        F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def star(spark: SparkSession, sf_dir: str):
    """The driver star of a directory."""
    return driver.star(spark, sf_dir)


def R(x: str) -> str:
    """round a SQL expression the way ``rounded`` does."""
    return f"round({x}, 6)"


# =====================================================================================
# Delay questions
# =====================================================================================

_LATENESS_SQL = """
    SELECT route_short_name, COUNT(*) AS n_observations, AVG(delay_seconds) AS avg_delay_sec,
           quantile_cont(delay_seconds, 0.5) AS median_delay_sec,
           AVG(CASE WHEN delay_seconds > 60 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pct_late,
           AVG(CASE WHEN delay_seconds > 300 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pct_very_late
    FROM measured GROUP BY route_short_name HAVING COUNT(*) >= 20"""


@register("route_lateness", with_views(["measured"], f"""
    SELECT route_short_name, n_observations, {R('avg_delay_sec')} AS avg_delay_sec,
           {R('median_delay_sec')} AS median_delay_sec, {R('pct_late')} AS pct_late,
           {R('pct_very_late')} AS pct_very_late,
           row_number() OVER (ORDER BY pct_late DESC, avg_delay_sec DESC, route_short_name ASC NULLS LAST) AS rank
    FROM ({_LATENESS_SQL})
    ORDER BY pct_late DESC, avg_delay_sec DESC, route_short_name ASC NULLS LAST LIMIT 25"""))
def q_route_lateness(spark, d):
    return A.route_lateness(star(spark, d))


@register("route_lateness_by_avg", with_views(["measured"], f"""
    SELECT route_short_name, n_observations, {R('avg_delay_sec')} AS avg_delay_sec,
           {R('median_delay_sec')} AS median_delay_sec, {R('pct_late')} AS pct_late,
           {R('pct_very_late')} AS pct_very_late,
           row_number() OVER (ORDER BY avg_delay_sec DESC, pct_late DESC, route_short_name ASC NULLS LAST) AS rank
    FROM ({_LATENESS_SQL} ORDER BY pct_late DESC, avg_delay_sec DESC, route_short_name ASC NULLS LAST LIMIT 25)"""))
def q_route_lateness_by_avg(spark, d):
    return A.rerank_lateness(A.route_lateness(star(spark, d)), by="avg")


@register("lateness_display", with_views(["measured"], f"""
    SELECT route_short_name, round_even(pct_late * 100 * 10, 0) / 10 AS pct_late_display,
           round_even(pct_very_late * 100 * 10, 0) / 10 AS pct_very_late_display,
           {R('avg_delay_sec / 60.0')} AS avg_delay_min, {R('median_delay_sec / 60.0')} AS median_delay_min,
           n_observations
    FROM ({_LATENESS_SQL} ORDER BY pct_late DESC, avg_delay_sec DESC, route_short_name ASC NULLS LAST LIMIT 25)"""))
def q_lateness_display(spark, d):
    return A.lateness_display(A.route_lateness(star(spark, d)))


@register("kpis", with_views(["facts"], f"""
    SELECT COUNT(*) AS total_facts, COUNT(DISTINCT trip_id) AS trips_observed,
           {R('quantile_cont(delay_seconds, 0.5)')} AS median_delay_sec,
           {R('AVG(CASE WHEN delay_seconds IS NULL THEN NULL WHEN delay_seconds <= 0 THEN 1.0 ELSE 0.0 END)::DOUBLE')} AS on_time_rate,
           COUNT(delay_seconds) AS observed_delay_count,
           {R('CASE WHEN COUNT(*) > 0 THEN COUNT(delay_seconds) / COUNT(*) END')} AS realtime_match_rate
    FROM facts"""))
def q_kpis(spark, d):
    return A.kpis(star(spark, d))


_FILTERED = Filters(start_date="1997-01-01", end_date="1998-12-31", vehicle_types=("Bus", "Metro"))


@register("filtered_kpis", with_views(["wide"], f"""
    SELECT COUNT(*) AS total_facts, COUNT(DISTINCT trip_id) AS trips_observed,
           {R('quantile_cont(delay_seconds, 0.5)')} AS median_delay_sec,
           {R('AVG(CASE WHEN delay_seconds IS NULL THEN NULL WHEN delay_seconds <= 0 THEN 1.0 ELSE 0.0 END)::DOUBLE')} AS on_time_rate,
           COUNT(delay_seconds) AS observed_delay_count,
           {R('CASE WHEN COUNT(*) > 0 THEN COUNT(delay_seconds) / COUNT(*) END')} AS realtime_match_rate
    FROM wide WHERE date_key BETWEEN 19970101 AND 19981231 AND type_name IN ('Bus', 'Metro')"""))
def q_filtered_kpis(spark, d):
    return A.kpis(star(spark, d), _FILTERED)


@register("date_range", with_views(["facts"], """
    SELECT MIN(full_date) AS min_date, MAX(full_date) AS max_date FROM facts"""))
def q_date_range(spark, d):
    return A.date_range(star(spark, d))


@register("default_window", with_views(["facts"], """
    SELECT GREATEST(MIN(full_date), CAST(MAX(full_date) - INTERVAL 6 DAY AS DATE)) AS start_date,
           MAX(full_date) AS end_date FROM facts"""))
def q_default_window(spark, d):
    return A.default_window(star(spark, d))


@register("worst_route", with_views(["measured"], """
    SELECT CASE WHEN COUNT(*) = 0 THEN 'N/A' ELSE MAX(route_short_name) END AS worst_route
    FROM (SELECT route_short_name, AVG(delay_seconds) AS a FROM measured GROUP BY route_short_name
          ORDER BY a DESC, route_short_name ASC NULLS LAST LIMIT 1)"""))
def q_worst_route(spark, d):
    return A.worst_route(star(spark, d))


@register("avg_delay_by_route", with_views(["measured"], f"""
    SELECT route_short_name, {R('avg_delay_sec')} AS avg_delay_sec, n_observations,
           row_number() OVER (ORDER BY avg_delay_sec DESC, route_short_name ASC NULLS LAST) AS rank
    FROM (SELECT route_short_name, AVG(delay_seconds) AS avg_delay_sec, COUNT(*) AS n_observations
          FROM measured GROUP BY route_short_name)
    ORDER BY avg_delay_sec DESC, route_short_name ASC NULLS LAST LIMIT 20"""))
def q_avg_delay_by_route(spark, d):
    return A.avg_delay_by_route(star(spark, d))


_HEATMAP_SQL = """
    SELECT day_name, day_of_week, hour_of_day, AVG(delay_seconds) AS avg_delay_sec
    FROM measured GROUP BY day_name, day_of_week, hour_of_day"""


@register("delay_heatmap", with_views(["measured"], f"""
    SELECT day_name, day_of_week, hour_of_day, {R('avg_delay_sec')} AS avg_delay_sec FROM ({_HEATMAP_SQL})"""))
def q_delay_heatmap(spark, d):
    return A.delay_heatmap(star(spark, d))


_PIVOT_COLS = ", ".join(
    f"{R(f'MAX(CASE WHEN hour_of_day = {h} THEN avg_delay_sec END)')} AS h{h:02d}" for h in range(24)
)


@register("heatmap_pivot", with_views(["measured"], f"""
    SELECT day_name, day_of_week, {_PIVOT_COLS} FROM ({_HEATMAP_SQL}) GROUP BY day_name, day_of_week"""))
def q_heatmap_pivot(spark, d):
    return A.heatmap_pivot(A.delay_heatmap(star(spark, d)))


@register("worst_time_slots", with_views(["measured"], f"""
    SELECT day_name, day_of_week, hour_of_day, {R('avg_delay_sec')} AS avg_delay_sec,
           row_number() OVER (ORDER BY avg_delay_sec DESC, day_of_week, hour_of_day) AS rank
    FROM ({_HEATMAP_SQL}) ORDER BY avg_delay_sec DESC, day_of_week, hour_of_day LIMIT 8"""))
def q_worst_time_slots(spark, d):
    return A.worst_time_slots(A.delay_heatmap(star(spark, d)))


@register("days_present", with_views(["measured"], f"""
    SELECT string_agg(day_name, ',' ORDER BY day_of_week) AS days, (SELECT COUNT(*) FROM ({_HEATMAP_SQL})) AS n_slots
    FROM (SELECT DISTINCT day_name, day_of_week FROM ({_HEATMAP_SQL}))"""))
def q_days_present(spark, d):
    return A.days_present(A.delay_heatmap(star(spark, d)))


@register("worst_stops", with_views(["measured"], f"""
    SELECT stop_name, stop_id, {R('avg_delay_sec')} AS avg_delay_sec, n_observations,
           row_number() OVER (ORDER BY avg_delay_sec DESC, stop_id) AS rank
    FROM (SELECT stop_name, stop_id, AVG(delay_seconds) AS avg_delay_sec, COUNT(*) AS n_observations
          FROM measured GROUP BY stop_name, stop_id HAVING COUNT(*) >= 3)
    ORDER BY avg_delay_sec DESC, stop_id LIMIT 10"""))
def q_worst_stops(spark, d):
    return A.worst_stops(star(spark, d))


_MAP_SQL = """
    SELECT stop_name, stop_lat, stop_lon, AVG(delay_seconds) AS avg_delay_sec, COUNT(*) AS n_observations
    FROM measured WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL
    GROUP BY stop_name, stop_lat, stop_lon"""


@register("stops_map", with_views(["measured"], f"""
    SELECT stop_name, {R('stop_lat')} AS stop_lat, {R('stop_lon')} AS stop_lon,
           {R('avg_delay_sec')} AS avg_delay_sec, n_observations FROM ({_MAP_SQL})"""))
def q_stops_map(spark, d):
    return A.stops_map(star(spark, d))


@register("stops_map_evidence", with_views(["measured"], f"""
    SELECT stop_name, {R('stop_lat')} AS stop_lat, {R('stop_lon')} AS stop_lon,
           {R('avg_delay_sec')} AS avg_delay_sec, n_observations FROM ({_MAP_SQL}) m
    WHERE n_observations >= 3 OR (SELECT COALESCE(MAX(n_observations), 0) FROM ({_MAP_SQL})) < 3"""))
def q_stops_map_evidence(spark, d):
    return A.stops_map_evidence(A.stops_map(star(spark, d)))


@register("robust_color_range", with_views(["measured"], f"""
    SELECT {R('CASE WHEN n = 0 THEN -5.0 WHEN hi - lo < 1.0 THEN mid - 5.0 - 0.5 ELSE lo - 0.5 END')} AS color_min,
           {R('CASE WHEN n = 0 THEN 15.0 WHEN hi - lo < 1.0 THEN mid + 5.0 + 0.5 ELSE hi + 0.5 END')} AS color_max
    FROM (SELECT quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.5) AS mid, quantile_cont(v, 0.95) AS hi,
                 COUNT(v) AS n
          FROM (SELECT avg_delay_sec / 60 AS v FROM ({_MAP_SQL}) WHERE n_observations >= 3))"""))
def q_robust_color_range(spark, d):
    m = A.stops_map_evidence(A.stops_map(star(spark, d)))
    return A.robust_color_range(m.withColumn("avg_delay_min", F.col("avg_delay_sec") / 60), "avg_delay_min")


_PUNCT_SQL = """
    SELECT COUNT(*) AS n,
           100.0 * COUNT(*) FILTER (WHERE m < -1) / COUNT(*) AS early_pct,
           100.0 * COUNT(*) FILTER (WHERE m BETWEEN -1 AND 1) / COUNT(*) AS on_time_pct,
           100.0 * COUNT(*) FILTER (WHERE m > 1) / COUNT(*) AS late_pct,
           100.0 * COUNT(*) FILTER (WHERE abs(m) <= 1) / COUNT(*) AS within_1_pct,
           100.0 * COUNT(*) FILTER (WHERE abs(m) <= 3) / COUNT(*) AS within_3_pct,
           100.0 * COUNT(*) FILTER (WHERE abs(m) <= 5) / COUNT(*) AS within_5_pct,
           100.0 * COUNT(*) FILTER (WHERE abs(m) <= 10) / COUNT(*) AS within_10_pct,
           quantile_cont(m, 0.5) AS median_min, quantile_cont(m, 0.9) AS p90_min
    FROM (SELECT delay_seconds / 60.0 AS m FROM facts WHERE delay_seconds IS NOT NULL)"""


@register("punctuality_summary", with_views(["facts"], f"""
    SELECT n, {R('early_pct')} AS early_pct, {R('on_time_pct')} AS on_time_pct, {R('late_pct')} AS late_pct,
           {R('within_1_pct')} AS within_1_pct, {R('within_3_pct')} AS within_3_pct,
           {R('within_5_pct')} AS within_5_pct, {R('within_10_pct')} AS within_10_pct,
           {R('median_min')} AS median_min, {R('p90_min')} AS p90_min FROM ({_PUNCT_SQL})"""))
def q_punctuality_summary(spark, d):
    return A.punctuality_summary(star(spark, d))


@register("punctuality_ladder", with_views(["facts"], f"""
    SELECT within_minutes, {R('percent')} AS percent FROM (
      SELECT 1 AS within_minutes, within_1_pct AS percent FROM ({_PUNCT_SQL})
      UNION ALL SELECT 3, within_3_pct FROM ({_PUNCT_SQL})
      UNION ALL SELECT 5, within_5_pct FROM ({_PUNCT_SQL})
      UNION ALL SELECT 10, within_10_pct FROM ({_PUNCT_SQL}))"""))
def q_punctuality_ladder(spark, d):
    return A.punctuality_ladder(A.punctuality_summary(star(spark, d)))


@register("punctuality_dominant", with_views(["facts"], f"""
    SELECT n, CASE WHEN n = 0 THEN NULL
                   WHEN early_pct >= on_time_pct AND early_pct >= late_pct THEN 'early'
                   WHEN on_time_pct >= late_pct THEN 'about on time' ELSE 'late' END AS dominant
    FROM ({_PUNCT_SQL})"""))
def q_punctuality_dominant(spark, d):
    return A.punctuality_dominant(A.punctuality_summary(star(spark, d)))


_NO_FACTS = Filters(start_date="1900-01-01", end_date="1900-01-02")


@register("punctuality_empty", """
    SELECT 0::BIGINT AS n, CAST(NULL AS DOUBLE) AS early_pct, CAST(NULL AS DOUBLE) AS within_5_pct, CAST(NULL AS DOUBLE) AS median_min,
           CAST(NULL AS VARCHAR) AS dominant""")
def q_punctuality_empty(spark, d):
    """A10-A12 under a filter that no fact passes: no rows is an answer, not an error."""
    s = A.punctuality_summary(star(spark, d), _NO_FACTS)
    return s.select("n", "early_pct", "within_5_pct", "median_min").join(A.punctuality_dominant(s), "n")  # one row each


@register("punctuality_story", with_views(["facts"], f"""
    SELECT format('{{:,}}', n) || ' measured stop arrivals: ' || format('{{:.0f}}', on_time_pct) || '% on time (within a minute), '
        || format('{{:.0f}}', early_pct) || '% early, ' || format('{{:.0f}}', late_pct) || '% late; the largest group is '
        || CASE WHEN early_pct >= on_time_pct AND early_pct >= late_pct THEN 'early' WHEN on_time_pct >= late_pct THEN 'about on time' ELSE 'late' END
        || '. The median is ' || format('{{:+.1f}}', median_min) || ' min off the plan, and nine in ten are at '
        || format('{{:+.1f}}', p90_min) || ' min or less.' AS story FROM ({_PUNCT_SQL})
    UNION ALL SELECT 'These filters leave no measured delays.'"""))
def q_punctuality_story(spark, d):
    """A12's sentence over all facts, and under a filter that none passes."""
    st = star(spark, d)
    return A.punctuality_story(A.punctuality_summary(st)).unionByName(A.punctuality_story(A.punctuality_summary(st, _NO_FACTS)))


@register("available_routes", with_views(["facts", "dim_route"], """
    SELECT DISTINCT r.route_id, r.route_short_name FROM dim_route r
    WHERE r.route_key IN (SELECT route_key FROM facts)"""))
def q_available_routes(spark, d):
    return A.available_routes(star(spark, d))


@register("available_vehicle_types", with_views(["facts", "dim_vehicle_type"], """
    SELECT DISTINCT vt.type_name FROM dim_vehicle_type vt
    WHERE vt.vehicle_type_key IN (SELECT vehicle_type_key FROM facts)"""))
def q_available_vehicle_types(spark, d):
    return A.available_vehicle_types(star(spark, d))


@register("delay_sample", with_views(["facts"], """
    SELECT delay_seconds FROM facts WHERE delay_seconds IS NOT NULL
    ORDER BY ('0x' || substr(md5(concat_ws('|', trip_id, stop_key, stop_sequence, date_key)), 1, 13))::BIGINT,
             trip_id, stop_key, stop_sequence, date_key LIMIT 20000"""))
def q_delay_sample(spark, d):
    return A.delay_sample(star(spark, d))


def _sample_sql(limit: int) -> str:
    return f"""
    SELECT delay_seconds FROM facts WHERE delay_seconds IS NOT NULL
    ORDER BY ('0x' || substr(md5(concat_ws('|', trip_id, stop_key, stop_sequence, date_key)), 1, 13))::BIGINT,
             trip_id, stop_key, stop_sequence, date_key LIMIT {limit}"""


@register("delay_sample_1", with_views(["facts"], _sample_sql(1)))
def q_delay_sample_1(spark, d):
    """A9 at the smallest limit."""
    return A.delay_sample(star(spark, d), sample_limit=1)


@register("delay_sample_7", with_views(["facts"], _sample_sql(7)))
def q_delay_sample_7(spark, d):
    return A.delay_sample(star(spark, d), sample_limit=7)


@register("route_filtered_kpis", with_views(["wide"], f"""
    SELECT COUNT(*) AS total_facts, COUNT(DISTINCT trip_id) AS trips_observed,
           {R('quantile_cont(delay_seconds, 0.5)')} AS median_delay_sec,
           {R('AVG(CASE WHEN delay_seconds IS NULL THEN NULL WHEN delay_seconds <= 0 THEN 1.0 ELSE 0.0 END)::DOUBLE')} AS on_time_rate,
           COUNT(delay_seconds) AS observed_delay_count,
           {R('CASE WHEN COUNT(*) > 0 THEN COUNT(delay_seconds) / COUNT(*) END')} AS realtime_match_rate
    FROM wide WHERE route_id IN ('7', '42', '119') AND date_key >= 19950301"""))
def q_route_filtered_kpis(spark, d):
    """The filter by route ids, with an open end of the dates."""
    return A.kpis(star(spark, d), Filters(start_date="1995-03-01", route_ids=("7", "42", "119")))
