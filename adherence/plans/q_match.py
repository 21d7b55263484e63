"""Registered transform queries: GTFS time functions, operator selection, realtime matching,
id diagnosis, calendar, lookups and the wide export (F1-F11, L1, P1-P3, P10, J1-J16, W1, U2, S14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from adherence.constants import REALTIME_FEED_REGIONAL, STATIC_FEED_NATIONAL
from adherence.functions import gtfs_time as T
from adherence.operators import dims as D
from adherence.operators import facts as FACTS
from adherence.operators import match as M
from adherence.operators.delays import delay_view
from adherence.plans.oracle import with_views
from adherence.plans.registry import R, register, star
from adherence.sources import driver

ZONE = "Europe/Stockholm"


def _epoch(ts: str) -> str:
    return f"CAST(epoch(timezone('{ZONE}', {ts})) AS BIGINT)"


def _hms(secs: str) -> str:
    return f"printf('%02d:%02d:%02d', ({secs}) // 3600, (({secs}) % 3600) // 60, ({secs}) % 60)"


def _parse(t: str) -> str:
    return (f"(CAST(split_part({t}, ':', 1) AS INTEGER) * 3600 + CAST(split_part({t}, ':', 2) AS INTEGER) * 60"
            f" + CAST(split_part({t}, ':', 3) AS INTEGER))")


_M_VIEWS = [
    ("st_txt", f"""
        SELECT CAST(s.l_orderkey AS VARCHAR) AS trip_id, CAST(o.o_custkey % 200 AS VARCHAR) AS route_id,
               CAST(s.l_suppkey AS VARCHAR) AS stop_id, CAST(s.l_linenumber AS VARCHAR) AS stop_sequence,
               {_hms('(5 + s.l_orderkey % 21) * 3600 + 7 * s.l_linenumber * 60')} AS arrival_time,
               CAST(o.o_orderdate AS DATE) AS service_date, o.o_custkey % 200 AS route_key
        FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_linenumber FROM lineitem) s
        JOIN orders o ON s.l_orderkey = o.o_orderkey"""),
    ("starts", f"""
        SELECT trip_id, CAST(service_date AS TIMESTAMP) + to_seconds(secs) AS trip_start_ts,
               {_epoch('CAST(service_date AS TIMESTAMP) + to_seconds(secs)')} AS trip_start_epoch
        FROM (SELECT trip_id, ANY_VALUE(service_date) AS service_date,
                     arg_min({_parse('arrival_time')}, CAST(stop_sequence AS INTEGER)) AS secs
              FROM st_txt GROUP BY trip_id)"""),
    ("sched", f"""
        SELECT s.trip_id, s.stop_id, s.stop_sequence, s.route_id, s.service_date,
               CAST(s.service_date AS TIMESTAMP) + to_seconds({_parse('s.arrival_time')}) AS scheduled_arrival,
               {_epoch(f"CAST(s.service_date AS TIMESTAMP) + to_seconds({_parse('s.arrival_time')})")} AS scheduled_epoch,
               b.trip_start_epoch
        FROM st_txt s LEFT JOIN starts b USING (trip_id)"""),
    ("rtd", f"""
        SELECT o_orderkey, o_custkey % 200 AS route_key, CAST(o_orderdate AS DATE) AS full_date,
               strftime(o_orderdate, '%Y%m%d') AS start_date,
               CASE WHEN o_orderpriority <> '5-LOW' THEN {_hms('(5 + o_orderkey % 21) * 3600 + (o_orderkey % 7) * 60')} END
                 AS start_time
        FROM orders"""),
    ("rt", f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(d.route_key AS VARCHAR) AS route_id,
               CASE WHEN start_time IS NOT NULL THEN
                 {_epoch(f"CAST(strptime(start_date, '%Y%m%d') AS TIMESTAMP) + to_seconds({_parse('start_time')})")} END
                 AS trip_start_epoch,
               start_date, CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN 'x' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS stop_id, CAST(l_linenumber AS VARCHAR) AS stop_sequence,
               CASE WHEN NOT (l_returnflag = 'N' AND l_linestatus = 'F') AND l_returnflag <> 'R'
                    THEN CAST((l_quantity - 20) * 30 AS INTEGER) END AS delay_seconds,
               CASE WHEN NOT (l_returnflag = 'N' AND l_linestatus = 'F') AND l_returnflag <> 'A'
                    THEN {_epoch('CAST(d.full_date AS TIMESTAMP) + to_seconds((5 + l_orderkey % 21) * 3600 + 7 * l_linenumber * 60)')}
                         + CAST((l_quantity - 20) * 30 AS INTEGER) END AS actual_epoch
        FROM lineitem JOIN rtd d ON l_orderkey = d.o_orderkey"""),
    ("primary_m", """
        SELECT s.*, r.delay_seconds, r.actual_epoch, r.stop_sequence AS rt_stop_sequence
        FROM sched s JOIN rt r USING (trip_id, stop_id)"""),
]


def _sql(body: str, views=("trips",)) -> str:
    return with_views(list(views), body, _M_VIEWS)


def _gtfs(spark, d):
    return driver.gtfs(spark, d)


def _sched(spark, d):
    # a per-operator (regional) feed: every agency is kept, so the whole timetable is matched
    return M.scheduled(_gtfs(spark, d), REALTIME_FEED_REGIONAL, zone=ZONE)


def _rt(spark, d):
    return M.prepare_realtime(driver.realtime_updates(spark, d, ZONE), REALTIME_FEED_REGIONAL, REALTIME_FEED_REGIONAL)


@register("gtfs_seconds", _sql(f"""
    SELECT trip_id, stop_id, stop_sequence, arrival_time, {_parse('arrival_time')} AS arrival_seconds FROM st_txt"""))
def q_gtfs_seconds(spark, d):
    """F1 over the whole timetable."""
    st = driver.stop_times_txt(spark, d)
    return st.select("trip_id", "stop_id", "stop_sequence", "arrival_time",
                     T.gtfs_time_to_seconds("arrival_time").alias("arrival_seconds"))


@register("scheduled_arrival", _sql("""
    SELECT trip_id, stop_id, stop_sequence, route_id, scheduled_arrival, scheduled_epoch, trip_start_epoch FROM sched"""))
def q_scheduled_arrival(spark, d):
    """F2 + zone-explicit epochs + W1, J3-J6 over the whole timetable."""
    return _sched(spark, d).select("trip_id", "stop_id", "stop_sequence", "route_id", "scheduled_arrival",
                                   "scheduled_epoch", "trip_start_epoch")


@register("trip_starts", _sql("SELECT trip_id, trip_start_ts, trip_start_epoch FROM starts"))
def q_trip_starts(spark, d):
    g = _gtfs(spark, d)
    st = M.operator_stop_times(g, REALTIME_FEED_REGIONAL)
    return M.trip_starts(st, ZONE)


@register("operator_stop_times", _sql("""
    SELECT s.trip_id, s.route_id, s.stop_id, s.stop_sequence, s.arrival_time FROM st_txt s
    WHERE s.route_key % 25 IN (0, 1)"""))
def q_operator_stop_times(spark, d):
    """P1 + J1-J3 for a national (multi-operator) feed: only the operator's agencies."""
    st = M.operator_stop_times(_gtfs(spark, d), STATIC_FEED_NATIONAL)
    return st.select("trip_id", "route_id", "stop_id", "stop_sequence", "arrival_time")


@register("rt_start_epoch", _sql(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, start_date, start_time,
           CASE WHEN start_time IS NOT NULL THEN
             {_epoch(f"CAST(strptime(start_date, '%Y%m%d') AS TIMESTAMP) + to_seconds({_parse('start_time')})")} END
             AS trip_start_epoch
    FROM rtd"""))
def q_rt_start_epoch(spark, d):
    """F4 on every realtime trip descriptor."""
    t = driver.rt_trip_descriptors(spark, d)
    return t.select(F.col("o_orderkey").cast("string").alias("trip_id"), "start_date", "start_time",
                    T.rt_start_to_epoch("start_date", "start_time", ZONE).alias("trip_start_epoch"))


@register("rt_match_primary", _sql("""
    SELECT trip_id, stop_id, stop_sequence, scheduled_epoch, delay_seconds, actual_epoch FROM primary_m"""))
def q_rt_match_primary(spark, d):
    """(trip_id, stop_id) match; realtime duplicates and repeated stops fan out."""
    m = M.match_primary(_sched(spark, d), _rt(spark, d))
    return m.select("trip_id", "stop_id", "stop_sequence", "scheduled_epoch", "delay_seconds", "actual_epoch")


@register("actual_and_delay", _sql(f"""
    SELECT trip_id, stop_id, stop_sequence, scheduled_arrival,
           CAST(timezone('{ZONE}', to_timestamp(COALESCE(actual_epoch, scheduled_epoch + delay_seconds))) AS TIMESTAMP)
             AS actual_arrival,
           COALESCE(actual_epoch, scheduled_epoch + delay_seconds) AS actual_epoch,
           CAST(COALESCE(delay_seconds, COALESCE(actual_epoch, scheduled_epoch + delay_seconds) - scheduled_epoch) AS INTEGER)
             AS delay_seconds
    FROM primary_m"""))
def q_actual_and_delay(spark, d):
    """F5/F6 on the primary match."""
    m = M.derive(M.match_primary(_sched(spark, d), _rt(spark, d)), ZONE)
    return m.select("trip_id", "stop_id", "stop_sequence", "scheduled_arrival", "actual_arrival", "actual_epoch",
                    "delay_seconds")


@register("rt_match_fallback", _sql("""
    SELECT s.trip_id, s.stop_id, s.stop_sequence, s.trip_start_epoch, r.trip_start_epoch AS rt_trip_start_epoch,
           r.delay_seconds, r.actual_epoch
    FROM sched s JOIN rt r ON s.route_id = r.route_id AND s.stop_id = r.stop_id AND s.stop_sequence = r.stop_sequence
      AND strftime(s.service_date, '%Y%m%d') = r.start_date
    WHERE r.trip_start_epoch IS NULL OR s.trip_start_epoch IS NULL
       OR abs(r.trip_start_epoch - s.trip_start_epoch) <= 300"""))
def q_rt_match_fallback(spark, d):
    """(route, stop, sequence) with the ±300 s start band, as a bucketed equi-join."""
    m = M.match_fallback(_sched(spark, d), _rt(spark, d))
    return m.select("trip_id", "stop_id", "stop_sequence", "trip_start_epoch", "rt_trip_start_epoch",
                    "delay_seconds", "actual_epoch")


@register("id_overlap", _sql("""
    SELECT 'trip_id' AS id_kind, (SELECT COUNT(DISTINCT trip_id) FROM st_txt) AS static_ids,
           (SELECT COUNT(DISTINCT trip_id) FROM rt) AS realtime_ids,
           (SELECT COUNT(*) FROM (SELECT DISTINCT trip_id FROM st_txt INTERSECT SELECT DISTINCT trip_id FROM rt)) AS common_ids
    UNION ALL
    SELECT 'route_id', (SELECT COUNT(DISTINCT route_id) FROM dim_route), (SELECT COUNT(DISTINCT route_id) FROM rt),
           (SELECT COUNT(*) FROM (SELECT DISTINCT route_id FROM dim_route INTERSECT SELECT DISTINCT route_id FROM rt))
    UNION ALL
    SELECT 'stop_id', (SELECT COUNT(DISTINCT stop_id) FROM dim_stop), (SELECT COUNT(DISTINCT stop_id) FROM rt),
           (SELECT COUNT(*) FROM (SELECT DISTINCT stop_id FROM dim_stop INTERSECT SELECT DISTINCT stop_id FROM rt))""",
    views=("trips", "dim_route", "dim_stop")))
def q_id_overlap(spark, d):
    """Static vs realtime id coverage for trips, routes and stops."""
    g = _gtfs(spark, d)
    static = M.ids_of(g.stop_times, ["trip_id"]).unionByName(M.ids_of(g.routes, ["route_id"])).unionByName(M.ids_of(g.stops, ["stop_id"]))
    return M.id_overlap(static, M.ids_of(_rt(spark, d), ["trip_id", "route_id", "stop_id"]))


@register("referenced_stops", _sql(f"""
    SELECT stop_id, stop_name, {R('stop_lat')} AS stop_lat, {R('stop_lon')} AS stop_lon FROM dim_stop
    WHERE stop_id IN (SELECT stop_id FROM st_txt)""", views=("trips", "dim_stop")))
def q_referenced_stops(spark, d):
    """J11 + F11: stops the timetable uses, coordinates parsed (blank -> NULL)."""
    g = _gtfs(spark, d)
    s = M.referenced_stops(g.stops, g.stop_times)
    return s.select("stop_id", "stop_name", T.parse_coordinate("stop_lat").alias("stop_lat"),
                    T.parse_coordinate("stop_lon").alias("stop_lon"))


@register("stop_id_translate", _sql("""
    SELECT rt_stop_id, translated, translated IN (SELECT '9011' || lpad(stop_id, 12, '0') FROM dim_stop) AS found
    FROM (SELECT DISTINCT '9022' || lpad(stop_id, 12, '0') AS rt_stop_id,
                 '9011' || lpad(stop_id, 12, '0') AS translated FROM rt)""", views=("trips", "dim_stop")))
def q_stop_id_translate(spark, d):
    """Realtime ids of the regional family (9022...) mapped onto the national family (9011...)."""
    rt = _rt(spark, d).select(F.concat(F.lit("9022"), F.lpad("stop_id", 12, "0")).alias("rt_stop_id")).distinct()
    national = driver.stop_dim(spark, d).select(
        F.concat(F.lit("9011"), F.lpad("stop_id", 12, "0")).alias("translated"), F.lit(True).alias("found"))
    t = rt.withColumn("translated", M.rt_stop_id(F.col("rt_stop_id"), STATIC_FEED_NATIONAL, REALTIME_FEED_REGIONAL))
    return t.join(national, "translated", "left").select(
        "rt_stop_id", "translated", F.coalesce("found", F.lit(False)).alias("found"))


@register("vehicle_lookup", with_views(["dim_route", "dim_vehicle_type"], """
    SELECT route_id, route_type, COALESCE(vt.vehicle_type_key, 4) AS vehicle_type_key,
           COALESCE(vt.type_name, 'Bus') AS type_name
    FROM (SELECT route_id, CASE WHEN route_key % 10 = 9 THEN '' WHEN route_key % 10 = 8 THEN '715'
                                ELSE CAST(route_key % 5 AS VARCHAR) END AS route_type FROM dim_route) r
    LEFT JOIN dim_vehicle_type vt ON vt.gtfs_route_type = COALESCE(TRY_CAST(trim(r.route_type) AS INTEGER), 3)"""))
def q_vehicle_lookup(spark, d):
    """Blank -> 3, unknown code -> the Bus key."""
    r = driver.routes_txt(spark, d).select("route_id", "route_type")
    vt = D.vehicle_type_dim(spark)
    out = D.lookup_vehicle_type(r, vt, F.col("route_type"))
    return out.join(F.broadcast(vt.select("vehicle_type_key", "type_name")), "vehicle_type_key").select(
        "route_id", "route_type", "vehicle_type_key", "type_name")


@register("calendar_dim", """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
           CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name, isodow(d) IN (6, 7) AS is_weekend,
           false AS is_swedish_holiday
    FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def q_calendar_dim(spark, d):
    """L1 + F9: one row per day over the span of the service dates."""
    o = driver.read(spark, d, "orders", "o_orderdate").select(F.to_date("o_orderdate").alias("full_date"))
    return D.calendar_from_dates(o)


@register("date_keys", """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date,
           CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key
    FROM orders""")
def q_date_keys(spark, d):
    """F3 on every service date."""
    o = driver.read(spark, d, "orders", "o_orderdate").select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return o.select("full_date", T.date_key("full_date").alias("date_key"))


_WIDE_COLS = ("date_key, full_date, day_name, day_of_week, trip_id, stop_sequence, scheduled_arrival, actual_arrival, "
              "delay_seconds, data_source, route_id, route_short_name, route_long_name, stop_id, stop_name, "
              "stop_lat, stop_lon, type_name, hour_of_day")


@register("wide_export", with_views(["wide"], f"SELECT {_WIDE_COLS} FROM wide"))
def q_wide_export(spark, d):
    """S14's 19-column wide delay rows (J12 full star join)."""
    st = star(spark, d)
    v = delay_view(st, route=True, stop=True, vehicle=True, date_attrs=True)
    v = v.withColumn("hour_of_day", T.hour_of("scheduled_arrival"))
    return v.select(*[c.strip() for c in _WIDE_COLS.split(",")])


@register("trip_sample", """
    SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey % 200 AS VARCHAR) AS route_id FROM orders
    WHERE ('0x' || substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < 0.05""")
def q_trip_sample(spark, d):
    g = _gtfs(spark, d)
    return M.sample_trips(g.trips, 0.05).select("trip_id", "route_id")


@register("transform_facts", with_views(["dim_vehicle_type"], f"""
    SELECT CAST(strftime(service_date, '%Y%m%d') AS INTEGER) AS date_key, trip_id, stop_id,
           CAST(stop_sequence AS INTEGER) AS stop_sequence, route_id, COALESCE(vt.vehicle_type_key, 4) AS vehicle_type_key,
           scheduled_arrival, CAST(timezone('{ZONE}', to_timestamp(ae)) AS TIMESTAMP) AS actual_arrival,
           delay2 AS delay_seconds
    FROM (SELECT *, CAST(COALESCE(rd, ae - scheduled_epoch) AS INTEGER) AS delay2 FROM (
            SELECT trip_id, stop_id, stop_sequence, route_id, service_date, scheduled_arrival, scheduled_epoch,
                   rt_stop_sequence, delay_seconds AS rd, COALESCE(actual_epoch, scheduled_epoch + delay_seconds) AS ae
            FROM primary_m)) d
    LEFT JOIN dim_vehicle_type vt ON vt.gtfs_route_type = COALESCE(TRY_CAST(
        CASE WHEN CAST(route_id AS INTEGER) % 10 = 9 THEN '' WHEN CAST(route_id AS INTEGER) % 10 = 8 THEN '715'
             ELSE CAST(CAST(route_id AS INTEGER) % 5 AS VARCHAR) END AS INTEGER), 3)
    QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, service_date, stop_sequence
        ORDER BY COALESCE(rt_stop_sequence = stop_sequence, false) DESC, ae DESC NULLS LAST,
                 delay2 DESC NULLS LAST) = 1""", _M_VIEWS))
def q_transform_facts(spark, d):
    """The load path on the driver data: J7 match -> F5/F6 derive -> J15/J16 key lookup -> D12
    rejects -> W3 de-duplication (D8 order) -> fact rows, reported with natural keys."""
    return _load_path(spark, d, _rt(spark, d))


def _load_path(spark, d, rt, with_strategy=False):
    g = _gtfs(spark, d)
    matched, strategy = M.match(_sched(spark, d), rt)  # J9
    derived = M.derive(matched, ZONE)
    routes = D.merge_scd1(None, g.routes.select("route_id", "route_short_name", "route_long_name"),
                          ["route_id"], "SL", "route_key")
    stops = D.merge_scd1(None, g.stops.select("stop_id", "stop_name"), ["stop_id"], "SL", "stop_key")
    facts, _, _ = FACTS.build(derived, routes, stops, D.vehicle_type_dim(spark), operator="SL")
    out = D.join_dim(facts, routes.select("route_key", "route_id"), "route_key")
    out = D.join_dim(out, stops.select("stop_key", "stop_id"), "stop_key")
    return out.select("date_key", "trip_id", "stop_id", "stop_sequence", "route_id", "vehicle_type_key",
                      "scheduled_arrival", "actual_arrival", "delay_seconds", *([F.lit(strategy).alias("strategy")] if with_strategy else []))


_FALLBACK_M = ("fallback_m", """
    SELECT s.*, r.delay_seconds, r.actual_epoch FROM sched s
    JOIN rt r ON s.route_id = r.route_id AND s.stop_id = r.stop_id AND s.stop_sequence = r.stop_sequence
      AND strftime(s.service_date, '%Y%m%d') = r.start_date
    WHERE r.trip_start_epoch IS NULL OR s.trip_start_epoch IS NULL OR abs(r.trip_start_epoch - s.trip_start_epoch) <= 300""")


@register("transform_facts_fallback", with_views(["dim_vehicle_type"], f"""
    SELECT CAST(strftime(service_date, '%Y%m%d') AS INTEGER) AS date_key, trip_id, stop_id,
           CAST(stop_sequence AS INTEGER) AS stop_sequence, route_id, COALESCE(vt.vehicle_type_key, 4) AS vehicle_type_key,
           scheduled_arrival, CAST(timezone('{ZONE}', to_timestamp(ae)) AS TIMESTAMP) AS actual_arrival,
           delay2 AS delay_seconds, 'fallback' AS strategy
    FROM (SELECT *, CAST(COALESCE(rd, ae - scheduled_epoch) AS INTEGER) AS delay2 FROM (
            SELECT trip_id, stop_id, stop_sequence, route_id, service_date, scheduled_arrival, scheduled_epoch,
                   delay_seconds AS rd, COALESCE(actual_epoch, scheduled_epoch + delay_seconds) AS ae
            FROM fallback_m)) d
    LEFT JOIN dim_vehicle_type vt ON vt.gtfs_route_type = COALESCE(TRY_CAST(
        CASE WHEN CAST(route_id AS INTEGER) % 10 = 9 THEN '' WHEN CAST(route_id AS INTEGER) % 10 = 8 THEN '715'
             ELSE CAST(CAST(route_id AS INTEGER) % 5 AS VARCHAR) END AS INTEGER), 3)
    QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, service_date, stop_sequence
        ORDER BY ae DESC NULLS LAST, delay2 DESC NULLS LAST) = 1""", [*_M_VIEWS, _FALLBACK_M]))
def q_transform_facts_fallback(spark, d):
    """J9's other branch: the realtime feed names its trips otherwise, so the primary match is empty and
    the load goes by route, stop, sequence and start."""
    rt = _rt(spark, d).withColumn("trip_id", F.concat(F.lit("other:"), "trip_id"))
    return _load_path(spark, d, rt, with_strategy=True)


@register("sampled_stop_times", with_views([], """
    SELECT trip_id, route_id, stop_id, stop_sequence, service_date FROM st_txt
    WHERE ('0x' || substr(md5('42|' || trip_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < 0.05""", _M_VIEWS))
def q_sampled_stop_times(spark, d):
    """The stop times of the sampled trips."""
    st = M.operator_stop_times(_gtfs(spark, d), REALTIME_FEED_REGIONAL, sample_fraction=0.05)
    return st.select("trip_id", "route_id", "stop_id", "stop_sequence", "service_date")


@register("dim_merge", """
    SELECT c_custkey AS customer, 'op' AS operator,
           c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ' new' END AS name,
           CASE WHEN c_custkey % 2 = 0 THEN 'kept' ELSE 'incoming' END AS origin
    FROM customer""")
def q_dim_merge(spark, d):
    """L3/L4: the SCD-1 update path: every customer is in the dimension, those with an odd key come in
    again with another name (twice, with an older one to lose), and win."""
    c = driver.read(spark, d, "customer", "c_custkey", "c_mktsegment").select(F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("name"))
    existing = D.merge_scd1(None, c.withColumn("origin", F.lit("kept")), ["customer"], "op", "customer_key")
    odd = c.where("customer % 2 = 1").withColumn("origin", F.lit("incoming"))
    incoming = odd.withColumn("name", F.concat("name", F.lit(" new"))).unionByName(odd)
    out = D.merge_scd1(existing, incoming, ["customer"], "op", "customer_key")
    return out.select("customer", "operator", "name", "origin")


_FLAT = """
    SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_suppkey AS VARCHAR) AS stop_id, l_linenumber AS stop_sequence,
           CASE WHEN l_returnflag <> 'N' THEN CAST((l_quantity - 20) * 30 AS INTEGER) END AS delay_seconds,
           CASE WHEN l_returnflag = 'R' THEN 1700000000 + l_orderkey END AS actual_epoch,
           CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS VARCHAR) END AS route_id
    FROM lineitem WHERE l_linenumber <> 6"""


@register("feed_flatten", _FLAT)
def q_feed_flatten(spark, d):
    """Every lineitem as an update of a JSON feed, written and flattened again: arrivals
    (flag R: delay and time), departures only (A: a delay), neither (N); blank route ids become NULL and
    updates with a blank stop id (line 6) are dropped, as the flattening does."""
    from adherence.sources import tripupdates as TU

    li = driver.read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    delay = ((F.col("l_quantity") - 20) * 30).cast("int")
    flag = F.col("l_returnflag")
    arrival = F.when(flag == "R", F.struct(delay.alias("delay"), (F.lit(1700000000) + F.col("l_orderkey")).alias("time")))
    departure = F.when(flag != "N", F.struct(delay.alias("delay")))
    stop = F.when(F.col("l_linenumber") == 6, F.lit("")).otherwise(F.col("l_suppkey").cast("string"))
    update = F.struct(F.col("l_linenumber").alias("stop_sequence"), stop.alias("stop_id"), arrival.alias("arrival"), departure.alias("departure"))
    route = F.when(F.col("l_linestatus") == "F", F.col("l_partkey").cast("string")).otherwise(F.lit(""))
    trip = F.struct(F.col("l_orderkey").cast("string").alias("trip_id"), route.alias("route_id"))
    entity = F.struct(F.struct(trip.alias("trip"), F.array(update).alias("stop_time_update")).alias("trip_update"))
    feed = li.select(F.to_json(F.struct(F.array(entity).alias("entity"))).alias("value"))
    feed = feed.select(F.from_json("value", TU.JSON_SCHEMA).alias("f")).select("f.entity")
    return TU.flatten_json(feed).select("trip_id", "stop_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), "delay_seconds", "actual_epoch", "route_id")


@register("wide_csv_parse", """
    SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_linenumber AS stop_sequence,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS TIMESTAMP) END AS scheduled_arrival,
           CAST(l_quantity AS INTEGER) AS delay_seconds,
           CASE WHEN l_returnflag = 'A' THEN 3 WHEN l_returnflag = 'R' THEN CAST(hour(CAST(l_shipdate AS TIMESTAMP)) AS INTEGER) END AS hour_of_day
    FROM lineitem""")
def q_wide_csv_parse(spark, d):
    """Every lineitem as a line of the wide CSV (an unreadable time on flag N, an hour given on A
    only), parsed as the reader parses files."""
    from adherence.sources import warehouse as W

    li = driver.read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag")
    flag = F.col("l_returnflag")
    when = F.when(flag == "N", F.lit("not a time")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    given = {"trip_id": F.col("l_orderkey").cast("string"), "stop_sequence": F.col("l_linenumber").cast("string"),
             "scheduled_arrival": when, "delay_seconds": F.col("l_quantity").cast("int").cast("string"),
             "hour_of_day": F.when(flag == "A", F.lit("3"))}
    cells = [F.coalesce(given.get(f.name, F.lit(None).cast("string")), F.lit("")) for f in W.WIDE_SCHEMA.fields]
    out = W.parse_wide(li.select(F.concat_ws(",", *cells).alias("value")))
    return out.select("trip_id", "stop_sequence", "scheduled_arrival", "delay_seconds", "hour_of_day")


@register("latest_run", """
    SELECT service_date, run_id, status, rows_fact, dq_status FROM (
      SELECT CAST(o_orderdate AS DATE) AS service_date, CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS status, o_custkey AS rows_fact,
             CASE WHEN o_orderkey % 3 = 0 THEN 'warn' WHEN o_orderkey % 3 = 1 THEN 'passed' ELSE loose END AS dq_status,
             row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey % 1000 DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn
      FROM orders LEFT JOIN (SELECT o_orderdate AS od, 'failed' AS loose FROM orders WHERE o_orderkey % 7 = 0 GROUP BY o_orderdate) ON od = o_orderdate)
    WHERE rn = 1""")
def q_latest_run(spark, d):
    """Orders as runs of their date; two of three have an event of their own, some dates have
    an event that names no run, which only counts where the latest run has none."""
    from adherence.operators import runs as RUNS

    o = driver.read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    key, none = F.col("o_orderkey"), F.lit(None)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + key % 1000)

    def event(run_id, dag, status, n, dq):
        return [run_id.cast("string").alias("run_id"), dag.cast("string").alias("dag_run_id"), F.to_date("o_orderdate").alias("service_date"), none.cast("timestamp").alias("started_at"),
                at.alias("finished_at"), status.cast("string").alias("status"), none.cast("long").alias("rows_ingested"), n.cast("long").alias("rows_fact"), dq.cast("string").alias("dq_status")]

    runs = o.select(*event(key, key, F.col("o_orderpriority"), F.col("o_custkey"), none))
    own = o.where(key % 3 < 2).select(*event(none, key, none, none, F.when(key % 3 == 0, "warn").otherwise("passed")))
    loose = o.where(key % 7 == 0).select(*event(none, none, none, none, F.lit("failed")))
    return RUNS.latest(runs.unionByName(own).unionByName(loose)).select("service_date", "run_id", "status", "rows_fact", "dq_status")
