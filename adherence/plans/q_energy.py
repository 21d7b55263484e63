"""Registered energy-score queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from adherence.functions.numeric import display_round
from adherence.operators import delays as A
from adherence.operators import energy as E
from adherence.plans.oracle import with_views
from adherence.plans.registry import R, register, star

_HAV = """2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(stop_lat - plat) / 2), 2)
          + cos(radians(plat)) * cos(radians(stop_lat)) * pow(sin(radians(stop_lon - plon) / 2), 2))))"""

_E_VIEWS = [
    ("bus", """
        SELECT f.date_key, f.route_key, f.vehicle_type_key, f.trip_id, f.stop_sequence, f.stop_key,
               f.scheduled_arrival, f.actual_arrival, f.delay_seconds, s.stop_lat, s.stop_lon
        FROM facts f JOIN dim_vehicle_type vt ON f.vehicle_type_key = vt.vehicle_type_key AND vt.type_name = 'Bus'
        JOIN dim_stop s ON f.stop_key = s.stop_key"""),
    ("legs", f"""
        SELECT *, CASE WHEN plat IS NOT NULL THEN {_HAV} END AS leg FROM (
          SELECT *, lag(stop_lat) OVER w AS plat, lag(stop_lon) OVER w AS plon FROM bus
          WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL
          WINDOW w AS (PARTITION BY date_key, trip_id ORDER BY stop_sequence, stop_key))"""),
    ("geo", """
        SELECT date_key, trip_id, COALESCE(SUM(CASE WHEN leg <= 25 THEN leg END), 0.0) AS km,
               COUNT(*) AS n_stops, COUNT(*) FILTER (WHERE leg IS NOT NULL) AS n_legs,
               COUNT(*) FILTER (WHERE stop_lat BETWEEN 59.30 AND 59.36 AND stop_lon BETWEEN 17.98 AND 18.12) AS in_inner,
               COUNT(*) FILTER (WHERE stop_lat BETWEEN 59.24 AND 59.31 AND stop_lon BETWEEN 17.95 AND 18.15) AS in_south
        FROM legs GROUP BY date_key, trip_id"""),
    ("ends", """
        SELECT date_key, trip_id,
               MAX(CASE WHEN rn_a = 1 THEN COALESCE(actual_arrival, scheduled_arrival) END) AS t0,
               MAX(CASE WHEN rn_d = 1 THEN COALESCE(actual_arrival, scheduled_arrival) END) AS t1,
               MAX(CASE WHEN rn_a = 1 THEN route_key END) AS route_key,
               MAX(CASE WHEN rn_a = 1 THEN vehicle_type_key END) AS vehicle_type_key,
               COALESCE(SUM(GREATEST(delay_seconds, 0)), 0) / 3600.0 AS delay_hours
        FROM (SELECT *, row_number() OVER (PARTITION BY date_key, trip_id ORDER BY stop_sequence, stop_key) AS rn_a,
                        row_number() OVER (PARTITION BY date_key, trip_id ORDER BY stop_sequence DESC, stop_key DESC) AS rn_d
              FROM bus) GROUP BY date_key, trip_id"""),
    ("tg", """
        SELECT e.date_key, e.trip_id, e.route_key, e.vehicle_type_key, COALESCE(g.km, 0.0) AS km,
               COALESCE(g.n_stops, 0) AS n_stops, COALESCE(g.in_inner, 0) AS in_inner, COALESCE(g.in_south, 0) AS in_south,
               CASE WHEN t0 IS NULL OR t1 IS NULL OR date_diff('second', t0, t1) < 0 THEN 0.0
                    ELSE LEAST(date_diff('second', t0, t1) / 3600.0, 8.0) END AS hrs,
               e.delay_hours
        FROM ends e LEFT JOIN geo g USING (date_key, trip_id)"""),
    ("member", """
        SELECT *, 'all' AS region_id, 'All stops' AS region_name, CAST(NULL AS BIGINT) AS n_inside, true AS in_region FROM tg
        UNION ALL SELECT *, 'inner_stockholm', 'Inner Stockholm', in_inner,
               CASE WHEN n_stops > 0 THEN in_inner / n_stops >= 0.5 ELSE false END FROM tg
        UNION ALL SELECT *, 'south_stockholm', 'South Stockholm', in_south,
               CASE WHEN n_stops > 0 THEN in_south / n_stops >= 0.5 ELSE false END FROM tg"""),
    ("feat", """
        SELECT date_key, region_id, region_name, trip_id, route_key, vehicle_type_key, km, hrs, n_stops, delay_hours,
               0.35 * km + 0.35 * hrs + 0.2 * CAST(n_stops AS DOUBLE) + 0.1 * delay_hours AS raw_score
        FROM member WHERE n_stops >= 2 AND in_region AND hrs > 0"""),
    ("rt", """
        SELECT date_key, region_id, route_key, ANY_VALUE(region_name) AS region_name,
               arg_min(vehicle_type_key, trip_id) AS vehicle_type_key, CAST(COUNT(*) AS INTEGER) AS trip_count,
               SUM(km) AS total_km, SUM(hrs) AS total_hours, quantile_cont(hrs, 0.9) AS p90_hours,
               AVG(CAST(n_stops AS DOUBLE)) AS avg_stops, SUM(delay_hours) AS delay_hours, AVG(raw_score) AS raw_score,
               SUM(km) / COUNT(*) AS avg_km
        FROM feat GROUP BY date_key, region_id, route_key"""),
    ("sc", """
        SELECT *, CASE WHEN MAX(raw_score) OVER w - MIN(raw_score) OVER w < 1e-12 THEN 50.0
                       ELSE 100.0 * (raw_score - MIN(raw_score) OVER w) / (MAX(raw_score) OVER w - MIN(raw_score) OVER w) END
                  AS energy_score,
               CASE WHEN avg_km > 0.05 THEN avg_stops / avg_km ELSE 0.0 END AS spk,
               CASE WHEN total_hours > 0.05 THEN delay_hours / total_hours ELSE 0.0 END AS dr_peer,
               CASE WHEN p90_hours > 0.05 THEN delay_hours / p90_hours ELSE 0.0 END AS dr_route,
               CASE WHEN avg_km > 0.05 THEN p90_hours / avg_km ELSE 0.0 END AS hpk
        FROM rt WINDOW w AS (PARTITION BY date_key, region_id)"""),
    ("th", """
        SELECT *, quantile_cont(avg_km, 0.75) OVER w AS km_p75, quantile_cont(p90_hours, 0.75) OVER w AS hours_p75,
               quantile_cont(spk, 0.75) OVER w AS spk_p75, quantile_cont(dr_peer, 0.75) OVER w AS dr_p75,
               quantile_cont(CAST(trip_count AS DOUBLE), 0.75) OVER w AS tc_p75,
               quantile_cont(hpk, 0.75) OVER w AS hpk_p75, quantile_cont(energy_score, 0.9) OVER w AS score_p90
        FROM sc WINDOW w AS (PARTITION BY date_key, region_id)"""),
    ("scores", """
        SELECT date_key, route_key, vehicle_type_key, region_id, region_name, trip_count, total_km, avg_km,
               total_hours, p90_hours, avg_stops, delay_hours, raw_score, energy_score,
               energy_score >= score_p90 AND p90_hours >= hours_p75 AS is_flagged,
               concat_ws(',',
                 CASE WHEN avg_km >= km_p75 AND km_p75 > 0 THEN 'LONG_DISTANCE' END,
                 CASE WHEN p90_hours >= hours_p75 AND hours_p75 > 0 THEN 'LONG_DURATION' END,
                 CASE WHEN spk >= spk_p75 AND spk_p75 > 0 THEN 'HIGH_STOP_DENSITY' END,
                 CASE WHEN dr_route >= dr_p75 AND dr_p75 > 0 THEN 'CONGESTION' END,
                 CASE WHEN CAST(trip_count AS DOUBLE) >= tc_p75 AND tc_p75 > 0 THEN 'HIGH_FREQUENCY' END,
                 CASE WHEN hpk >= hpk_p75 AND hpk_p75 > 0 THEN 'SLOW_SPEED' END) AS flag_reasons,
               'estimate_v1' AS data_source
        FROM th"""),
    ("view_all", """
        SELECT CAST(strptime(CAST(e.date_key AS VARCHAR), '%Y%m%d') AS DATE) AS full_date, e.date_key, e.region_id,
               e.region_name, r.route_id, r.route_short_name, r.route_long_name, e.trip_count, e.avg_km, e.total_km,
               e.p90_hours, e.total_hours, e.avg_stops, e.delay_hours, e.energy_score, e.is_flagged, e.flag_reasons
        FROM scores e JOIN dim_route r ON e.route_key = r.route_key WHERE e.region_id = 'all'"""),
    ("collapsed", """
        SELECT route_id, route_short_name, route_long_name, CAST(SUM(trip_count) AS BIGINT) AS trip_count, AVG(avg_km) AS avg_km,
               SUM(total_km) AS total_km, MAX(p90_hours) AS p90_hours, SUM(total_hours) AS total_hours,
               AVG(avg_stops) AS avg_stops, SUM(delay_hours) AS delay_hours, AVG(energy_score) AS energy_score,
               BOOL_OR(is_flagged) AS is_flagged,
               arg_max(flag_reasons, (energy_score, p90_hours, date_key)) AS flag_reasons
        FROM view_all GROUP BY route_id, route_short_name, route_long_name"""),
]


def _sql(body: str) -> str:
    return with_views(["facts", "dim_stop", "dim_vehicle_type", "dim_route"], body, _E_VIEWS)


def _rows(spark, d):
    return E.bus_stop_rows(star(spark, d))


def _scores(spark, d):
    return E.compute(star(spark, d))


def _collapsed(spark, d):
    st = star(spark, d)
    return E.collapse(E.read_scores(E.compute(st), st, region_id="all"))


_SCORE_COLS = ("date_key, route_key, vehicle_type_key, region_id, region_name, trip_count, "
               + ", ".join(f"{R(c)} AS {c}" for c in
                           ["total_km", "avg_km", "total_hours", "p90_hours", "avg_stops", "delay_hours",
                            "raw_score", "energy_score"])
               + ", is_flagged, flag_reasons, data_source")


@register("trip_path_km", _sql(f"""
    SELECT date_key, trip_id, {R('km')} AS km, n_stops, n_legs FROM geo"""))
def q_trip_path_km(spark, d):
    """Path length over consecutive located stops (legs > 25 km dropped)."""
    legs = E.with_legs(_rows(spark, d)).filter("_located")
    return legs.groupBy("date_key", "trip_id").agg(
        F.coalesce(F.sum(F.when(F.col("leg_km") <= 25.0, F.col("leg_km"))), F.lit(0.0)).alias("km"),
        F.count(F.lit(1)).alias("n_stops"),
        F.count("leg_km").alias("n_legs"),
    )


@register("region_membership", _sql("""
    SELECT date_key, trip_id, region_id, n_stops, n_inside, in_region FROM member"""))
def q_region_membership(spark, d):
    m = E.region_membership(E.trip_geometry(_rows(spark, d)))
    return m.select("date_key", "trip_id", "region_id", "n_stops", "n_inside", "in_region")


@register("trip_features", _sql(f"""
    SELECT date_key, region_id, region_name, trip_id, route_key, vehicle_type_key, {R('km')} AS km,
           {R('hrs')} AS hours, n_stops, {R('delay_hours')} AS delay_hours, {R('raw_score')} AS raw_score FROM feat"""))
def q_trip_features(spark, d):
    return E.trip_features(_rows(spark, d))


@register("route_energy", _sql(f"SELECT {_SCORE_COLS} FROM scores"))
def q_route_energy(spark, d):
    return _scores(spark, d)


@register("energy_thresholds", _sql(f"""
    SELECT date_key, region_id, COUNT(*) AS n_routes, {R('quantile_cont(avg_km, 0.75)')} AS km_p75,
           {R('quantile_cont(p90_hours, 0.75)')} AS hours_p75, {R('quantile_cont(spk, 0.75)')} AS spk_p75,
           {R('quantile_cont(dr_peer, 0.75)')} AS dr_p75,
           {R('quantile_cont(CAST(trip_count AS DOUBLE), 0.75)')} AS tc_p75,
           {R('quantile_cont(hpk, 0.75)')} AS hpk_p75
    FROM sc GROUP BY date_key, region_id"""))
def q_energy_thresholds(spark, d):
    st = star(spark, d)
    return E.thresholds(E.route_aggregate(E.trip_features(E.bus_stop_rows(st))))


@register("energy_flags", _sql("""
    SELECT date_key, region_id, route_key, is_flagged, flag_reasons FROM scores"""))
def q_energy_flags(spark, d):
    return _scores(spark, d).select("date_key", "region_id", "route_key", "is_flagged", "flag_reasons")


@register("energy_read", _sql(f"""
    SELECT full_date, date_key, region_id, region_name, route_id, route_short_name, route_long_name, trip_count,
           {R('avg_km')} AS avg_km, {R('total_km')} AS total_km, {R('p90_hours')} AS p90_hours,
           {R('total_hours')} AS total_hours, {R('avg_stops')} AS avg_stops, {R('delay_hours')} AS delay_hours,
           {R('energy_score')} AS energy_score, is_flagged, flag_reasons FROM view_all"""))
def q_energy_read(spark, d):
    st = star(spark, d)
    return E.read_scores(E.compute(st), st, region_id="all")


@register("energy_multi_day", _sql(f"""
    SELECT route_id, route_short_name, route_long_name, trip_count, {R('avg_km')} AS avg_km, {R('total_km')} AS total_km,
           {R('p90_hours')} AS p90_hours, {R('total_hours')} AS total_hours, {R('avg_stops')} AS avg_stops,
           {R('delay_hours')} AS delay_hours, {R('energy_score')} AS energy_score, is_flagged, flag_reasons
    FROM collapsed"""))
def q_energy_multi_day(spark, d):
    return _collapsed(spark, d)


@register("energy_kpis", _sql(f"""
    SELECT COUNT(*) AS routes_scored, COUNT(*) FILTER (WHERE is_flagged) AS routes_flagged,
           {R('AVG(energy_score)')} AS mean_score FROM collapsed"""))
def q_energy_kpis(spark, d):
    return E.kpis(_collapsed(spark, d))


@register("energy_top", _sql(f"""
    SELECT route_short_name, {R('energy_score')} AS energy_score, {R('p90_hours')} AS p90_hours,
           row_number() OVER (ORDER BY energy_score DESC, p90_hours DESC, route_id) AS rank
    FROM collapsed ORDER BY energy_score DESC, p90_hours DESC, route_id LIMIT 15"""))
def q_energy_top(spark, d):
    """Top 15 routes by mean score."""
    c = _collapsed(spark, d)
    return A.top_k(c, 15, F.col("energy_score").desc(), F.col("p90_hours").desc(), F.col("route_id").asc()).select(
        "route_short_name", "energy_score", "p90_hours", "rank")


@register("energy_top_hours", _sql(f"""
    SELECT route_short_name, {R('p90_hours')} AS p90_hours, {R('energy_score')} AS energy_score,
           row_number() OVER (ORDER BY p90_hours DESC, energy_score DESC, route_id) AS rank
    FROM collapsed ORDER BY p90_hours DESC, energy_score DESC, route_id LIMIT 15"""))
def q_energy_top_hours(spark, d):
    """Top 15 routes by the 90th percentile of trip hours."""
    c = _collapsed(spark, d)
    return A.top_k(c, 15, F.col("p90_hours").desc(), F.col("energy_score").desc(), F.col("route_id").asc()).select(
        "route_short_name", "p90_hours", "energy_score", "rank")


@register("energy_flagged_list", _sql("""
    SELECT route_short_name, route_long_name, round_even(energy_score * 10, 0) / 10 AS energy_score,
           round_even(p90_hours * 100, 0) / 100 AS p90_hours,
           round_even(avg_km * 10, 0) / 10 AS avg_km, trip_count, flag_reasons FROM collapsed WHERE is_flagged"""))
def q_energy_flagged_list(spark, d):
    """Flagged routes with display rounding (reasons shown only for flagged ones, D25)."""
    c = _collapsed(spark, d).filter("is_flagged")
    return c.select("route_short_name", "route_long_name", display_round("energy_score", 1).alias("energy_score"),
                    display_round("p90_hours", 2).alias("p90_hours"), display_round("avg_km", 1).alias("avg_km"),
                    "trip_count", "flag_reasons")
