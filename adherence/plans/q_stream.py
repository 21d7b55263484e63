"""Registered snapshot/stream queries over ``events`` (S7, R2, R3 batch twins).

events as realtime snapshots: key (user_id, k from props), value as the delay, ts as the
snapshot time."""

from __future__ import annotations

from pyspark.sql import functions as F

from adherence.plans.registry import R, register
from adherence.sources import driver
from adherence.streaming import snapshots as S


def _events(spark, d):
    e = driver.read(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return e.withColumn("k", F.get_json_object("props", "$.k").try_cast("int")).drop("props")


@register("latest_snapshot", f"""
    WITH e AS (SELECT *, CAST(ts AS DATE) AS service_date, time_bucket(INTERVAL 15 MINUTE, ts) AS snapshot_ts,
                      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    SELECT service_date, snapshot_ts, event_id, user_id, k, {R('value')} AS value FROM e
    WHERE (service_date, snapshot_ts) IN (SELECT (service_date, MAX(snapshot_ts)) FROM e GROUP BY service_date)""")
def q_latest_snapshot(spark, d):
    s = S.latest_snapshot_rows(_events(spark, d))
    return s.select("service_date", "snapshot_ts", "event_id", "user_id", "k", "value")


@register("latest_update", f"""
    SELECT user_id, k, {R('arg_max(value, (ts, event_id))')} AS value, MAX(ts) AS ts,
           arg_max(event_id, (ts, event_id)) AS event_id
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY user_id, k""")
def q_latest_update(spark, d):
    return S.latest_per_key(_events(spark, d), ["user_id", "k"], ["ts", "event_id"], ["value"])


@register("window_delay", f"""
    SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, event_type,
           COUNT(*) AS n, {R('AVG(value)')} AS avg_value
    FROM events GROUP BY ALL""")
def q_window_delay(spark, d):
    return S.window_stats(_events(spark, d), "ts", ["event_type"], "value")
