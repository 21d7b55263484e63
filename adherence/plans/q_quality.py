"""Registered data-quality and load queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from adherence.operators import quality as Q
from adherence.operators.dims import join_dim
from adherence.plans.oracle import with_views
from adherence.plans.registry import register, star
from adherence.session import ensure_checkpoint_dir
from adherence.sources import driver
from adherence.sources import versions as V

AS_OF = "2030-01-01"

_QFACTS = ("qfacts", """
    SELECT date_key, full_date, route_key, stop_key, vehicle_type_key,
           CASE WHEN CAST(trip_id AS BIGINT) % 101 <> 0 THEN trip_id END AS trip_id,
           stop_sequence, scheduled_arrival, actual_arrival,
           CASE WHEN CAST(trip_id AS BIGINT) % 97 = 0 THEN delay_seconds * 20 ELSE delay_seconds END AS delay_seconds
    FROM facts""")
_QSTOPS = ("qstops", """
    SELECT CASE WHEN s.s_acctbal < 0 THEN -d.stop_key ELSE d.stop_key END AS stop_key, d.stop_id, d.stop_name, d.stop_lat, d.stop_lon
    FROM dim_stop d JOIN supplier s ON d.stop_key = s.s_suppkey""")
_RAW = ("raw_facts", """
    SELECT t.date_key, CAST(l_orderkey AS VARCHAR) AS trip_id, l_suppkey AS stop_key, l_linenumber AS stop_sequence,
           t.route_key
    FROM lineitem JOIN trips t ON l_orderkey = t.o_orderkey""")

_STATS_SQL = """
    SELECT date_key, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE trip_id IS NULL) AS null_trip_ids,
           COUNT(*) FILTER (WHERE delay_seconds IS NOT NULL AND (delay_seconds < -3600 OR delay_seconds > 10800)) AS out_of_range,
           COUNT(*) FILTER (WHERE delay_seconds IS NULL) AS null_delays
    FROM qfacts GROUP BY date_key"""
_DUPS_SQL = """
    SELECT date_key, CAST(SUM(cnt - 1) AS BIGINT) AS dup_count FROM (
      SELECT date_key, trip_id, stop_key, stop_sequence, COUNT(*) AS cnt FROM raw_facts
      GROUP BY date_key, trip_id, stop_key, stop_sequence) GROUP BY date_key"""
_ORPHANS_BY_DATE_SQL = """
    SELECT date_key, COUNT(*) AS orphan_rows FROM qfacts
    WHERE stop_key NOT IN (SELECT stop_key FROM qstops) GROUP BY date_key"""


def _qfacts(spark, d):
    return driver.quality_facts(star(spark, d).facts)


def _raw(spark, d):
    return driver.facts(spark, d, dedupe=False)


def _report(spark, d):
    """All checks from one pass: the de-duplicated facts know how many raw rows stand behind each."""
    f = driver.facts(spark, d, counts=True)
    f = driver.quality_facts(f.withColumn("visit_trip", F.col("trip_id")))
    grain = ["visit_trip", "stop_key", "date_key", "stop_sequence"]
    p = Q.profile(f, {"stop": (driver.loaded_stop_dim(spark, d), "stop_key")}, grain, copies="n_rows")
    return Q.report_of(p, _age())


def _age():
    """Q7: days between the feed's pull and the as-of date, which is injected.  The fixture's feed of a
    date was pulled as many days before as the days to ``AS_OF`` have over tens."""
    days = F.datediff(F.lit(AS_OF).cast("date"), F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    return F.pmod(days, F.lit(10)).cast("double")


@register("dq_stats", with_views(["facts"], _STATS_SQL, [_QFACTS]))
def q_dq_stats(spark, d):
    return Q.fact_stats(_qfacts(spark, d))


@register("dq_duplicates", with_views(["trips"], _DUPS_SQL, [_RAW]))
def q_dq_duplicates(spark, d):
    return Q.duplicate_grain(_raw(spark, d))


@register("dq_referential", with_views(["facts", "dim_stop", "dim_route", "dim_vehicle_type"], """
    SELECT 'stop' AS dimension, COUNT(*) AS orphan_rows FROM facts WHERE stop_key NOT IN (SELECT stop_key FROM qstops)
    UNION ALL SELECT 'route', COUNT(*) FROM facts WHERE route_key NOT IN (SELECT route_key FROM dim_route)
    UNION ALL SELECT 'vehicle_type', COUNT(*) FROM facts
              WHERE vehicle_type_key NOT IN (SELECT vehicle_type_key FROM dim_vehicle_type)""", [_QSTOPS]))
def q_dq_referential(spark, d):
    st = star(spark, d)
    return Q.referential(st.facts, {
        "stop": (driver.loaded_stop_dim(spark, d), "stop_key"),
        "route": (st.routes, "route_key"),
        "vehicle_type": (st.vehicle_types, "vehicle_type_key"),
    })


@register("orphans", with_views(["facts", "dim_stop"], """
    SELECT f.stop_key, COUNT(*) AS orphan_rows FROM facts f
    WHERE NOT EXISTS (SELECT 1 FROM qstops s WHERE s.stop_key = f.stop_key) GROUP BY f.stop_key""", [_QSTOPS]))
def q_orphans(spark, d):
    """The orphan keys themselves, with their fact counts."""
    f = driver.facts(spark, d)
    return f.join(driver.loaded_stop_dim(spark, d).select("stop_key"), "stop_key", "left_anti").groupBy(
        "stop_key").agg(F.count(F.lit(1)).alias("orphan_rows"))


_REPORT_J = ("rep_j", f"""
    SELECT s.*, CAST(date_diff('day', CAST(strptime(CAST(s.date_key AS VARCHAR), '%Y%m%d') AS DATE), DATE '{AS_OF}') % 10 AS DOUBLE) AS age,
           COALESCE(du.dup_count, 0) AS dup_count, COALESCE(o.orphan_rows, 0) AS orphan_rows
    FROM ({_STATS_SQL}) s LEFT JOIN ({_DUPS_SQL}) du USING (date_key)
    LEFT JOIN ({_ORPHANS_BY_DATE_SQL}) o USING (date_key)""")
_REPORT_SQL = """
    SELECT date_key, 'DQ-001' AS check_id, 'ERROR' AS severity, row_count > 0 AS passed, CAST(row_count AS DOUBLE) AS observed FROM rep_j j
    UNION ALL SELECT date_key, 'DQ-002', 'ERROR', null_trip_ids = 0, CAST(null_trip_ids AS DOUBLE) FROM rep_j j
    UNION ALL SELECT date_key, 'DQ-003', 'WARN', out_of_range = 0, CAST(out_of_range AS DOUBLE) FROM rep_j j
    UNION ALL SELECT date_key, 'DQ-004', 'WARN',
        (CASE WHEN row_count > 0 THEN null_delays / row_count ELSE 0.0 END) < 0.8,
        round(CASE WHEN row_count > 0 THEN null_delays / row_count ELSE 0.0 END, 6) FROM rep_j j
    UNION ALL SELECT date_key, 'DQ-005', 'ERROR', orphan_rows = 0, CAST(orphan_rows AS DOUBLE) FROM rep_j j
    UNION ALL SELECT date_key, 'DQ-006', 'ERROR', dup_count = 0, CAST(dup_count AS DOUBLE) FROM rep_j j
    UNION ALL SELECT date_key, 'DQ-007', 'WARN', age < 7, age FROM rep_j j"""


@register("dq_report", with_views(["facts", "dim_stop", "trips"], _REPORT_SQL, [_QFACTS, _QSTOPS, _RAW, _REPORT_J]))
def q_dq_report(spark, d):
    return _report(spark, d)


@register("dq_status", with_views(["facts", "dim_stop", "trips"], f"""
    SELECT date_key, CASE WHEN MAX(r) = 2 THEN 'failed' WHEN MAX(r) = 1 THEN 'warn' ELSE 'passed' END AS dq_status
    FROM (SELECT date_key, CASE WHEN NOT passed AND severity = 'ERROR' THEN 2 WHEN NOT passed THEN 1 ELSE 0 END AS r
          FROM ({_REPORT_SQL})) GROUP BY date_key""", [_QFACTS, _QSTOPS, _RAW, _REPORT_J]))
def q_dq_status(spark, d):
    return Q.status(_report(spark, d))


@register("dq_rejects", with_views(["facts"], """
    SELECT trip_id, stop_key, stop_sequence, date_key, delay_seconds,
           CASE WHEN trip_id IS NULL THEN 'null_trip_id'
                WHEN scheduled_arrival IS NULL THEN 'null_scheduled_arrival'
                WHEN stop_sequence IS NULL THEN 'null_stop_sequence'
                ELSE 'delay_out_of_range' END AS reject_reason
    FROM qfacts WHERE trip_id IS NULL OR scheduled_arrival IS NULL OR stop_sequence IS NULL
       OR (delay_seconds IS NOT NULL AND (delay_seconds < -3600 OR delay_seconds > 10800))""", [_QFACTS]))
def q_dq_rejects(spark, d):
    _, rejected = Q.split_rejects(_qfacts(spark, d))
    return rejected.select("trip_id", "stop_key", "stop_sequence", "date_key", "delay_seconds", "reject_reason")


@register("fact_dedupe", with_views(["trips_vt"], """
    SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_suppkey AS stop_key, l_linenumber AS stop_sequence, t.date_key,
           CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
                ELSE CAST((l_quantity - 20) * 30 AS INTEGER) END AS delay_seconds,
           CAST(n - 1 AS BIGINT) AS dup_count
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_suppkey, l_linenumber) AS n FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) = 1) li
    JOIN trips_vt t ON li.l_orderkey = t.o_orderkey"""))
def q_fact_dedupe(spark, d):
    """One row per grain, last one wins under the total order, with the collapse count."""
    li = driver.dedup_lineitem(spark, d)
    t = driver.order_trips(spark, d).select("o_orderkey", "date_key")
    delay = driver._delay(F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linestatus"))
    return li.join(t, li.l_orderkey == t.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("trip_id"), F.col("l_suppkey").alias("stop_key"),
        F.col("l_linenumber").alias("stop_sequence"), "date_key", delay.alias("delay_seconds"),
        F.col("dup_count").cast("bigint").alias("dup_count"),
    )


@register("key_lookup_report", with_views(["trips", "dim_stop", "dim_route"], """
    SELECT CAST(SUM(cnt) AS BIGINT) AS rows_seen,
           CAST(SUM(CASE WHEN has_dim THEN 1 ELSE 0 END) AS BIGINT) AS rows_loaded,
           CAST(SUM(CASE WHEN has_dim THEN 0 ELSE cnt END) AS BIGINT) AS skipped_no_dim,
           CAST(SUM(CASE WHEN has_dim THEN cnt - 1 ELSE 0 END) AS BIGINT) AS duplicates_collapsed
    FROM (SELECT r.trip_id, r.stop_key, r.stop_sequence, r.date_key, COUNT(*) AS cnt,
                 BOOL_AND(s.stop_key IS NOT NULL AND d.route_key IS NOT NULL) AS has_dim
          FROM raw_facts r LEFT JOIN qstops s ON r.stop_key = s.stop_key
          LEFT JOIN dim_route d ON r.route_key = d.route_key
          GROUP BY r.trip_id, r.stop_key, r.stop_sequence, r.date_key)""", [_QSTOPS, _RAW]))
def q_key_lookup_report(spark, d):
    """J15 + L10: rows seen, loaded, skipped for a missing dimension key, duplicates collapsed."""
    raw = _raw(spark, d)
    stops = driver.loaded_stop_dim(spark, d).select("stop_key", F.lit(True).alias("_s"))
    routes = driver.route_dim(spark, d).select("route_key", F.lit(True).alias("_r"))
    j = join_dim(raw, stops, "stop_key", how="left", rows=driver.read(spark, d, "lineitem").count())
    j = join_dim(j, routes, "route_key", how="left")
    return Q.load_report(j.withColumn("has_dim", F.col("_s").isNotNull() & F.col("_r").isNotNull()))


@register("reload_switch", with_views(["facts"], """
    SELECT year, kind, COUNT(*) AS n, CAST(SUM(delay_seconds) AS BIGINT) AS total FROM (
      SELECT CAST(date_key // 10000 AS INTEGER) AS year,
             CASE WHEN date_key // 10000 = 1997 THEN delay_seconds + 60 ELSE delay_seconds END AS delay_seconds,
             CASE WHEN delay_seconds IS NULL OR (date_key // 10000 = 1997 AND delay_seconds < 0) THEN 'rejected' ELSE 'loaded' END AS kind
      FROM facts WHERE date_key // 10000 <> 1995) GROUP BY year, kind"""))
def q_reload_switch(spark, d):
    """All years are loaded as facts and rejects (no delay); a second load replaces 1997 with other
    values and a stricter rule, and empties 1995, in both tables at once."""
    root = f"{ensure_checkpoint_dir(spark)}/reload-{uuid.uuid4().hex}"
    f = star(spark, d).facts.select((F.col("date_key") / 10000).cast("int").alias("year"), "trip_id", "stop_key", "delay_seconds")
    changed = f.where("year = 1997").withColumn("delay_seconds", F.col("delay_seconds") + 60)
    for rows, rejected, years in ((f, F.col("delay_seconds").isNull(), []),
                                  (changed, F.col("delay_seconds").isNull() | (F.col("delay_seconds") < 60), ["year=1995", "year=1997"])):
        load = V.Load(spark, root)
        load.write(rows.where(~rejected), "loaded", ["year"], years)
        load.write(rows.where(rejected), "rejected", ["year"], years)
        load.publish()
    both = [V.read(spark, root, kind).withColumn("kind", F.lit(kind)) for kind in ("loaded", "rejected")]
    return both[0].unionByName(both[1]).groupBy("year", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("delay_seconds").alias("total"))
