"""SQL-language functions for SQL users (the native expressions, visible to Catalyst).

``register(spark)`` creates temporary functions; they inline into the plan like any built-in
expression (no Python, no UDF boundary)::

    SELECT gtfs_seconds('25:30:00'), gtfs_local_datetime(DATE'2026-07-11', '25:30:00'),
           rt_start_epoch('20260712', '15:54:00', 'Europe/Stockholm'), date_key(DATE'2026-07-11'),
           haversine_km(59.33, 18.06, 59.34, 18.06)
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from adherence.constants import EARTH_RADIUS_KM

_SECONDS = ("CASE WHEN size(split(trim(t), ':')) = 3 THEN try_cast(try_add(try_add("
            "try_multiply(try_cast(get(split(trim(t), ':'), 0) AS BIGINT), 3600), "
            "try_multiply(try_cast(get(split(trim(t), ':'), 1) AS BIGINT), 60)), "
            "try_cast(get(split(trim(t), ':'), 2) AS BIGINT)) AS INT) END")

FUNCTIONS = [
    f"CREATE OR REPLACE TEMPORARY FUNCTION gtfs_seconds(t STRING) RETURNS INT RETURN {_SECONDS}",
    "CREATE OR REPLACE TEMPORARY FUNCTION gtfs_local_datetime(d DATE, t STRING) RETURNS TIMESTAMP_NTZ "
    "RETURN timestampadd(SECOND, gtfs_seconds(t), CAST(d AS TIMESTAMP_NTZ))",
    "CREATE OR REPLACE TEMPORARY FUNCTION local_to_epoch(ts TIMESTAMP_NTZ, zone STRING) RETURNS BIGINT "
    "RETURN timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', convert_timezone(zone, 'UTC', ts))",
    "CREATE OR REPLACE TEMPORARY FUNCTION rt_start_epoch(sd STRING, st STRING, zone STRING) RETURNS BIGINT "
    "RETURN CASE WHEN nullif(trim(sd), '') IS NULL OR nullif(trim(st), '') IS NULL THEN NULL "
    "WHEN instr(trim(st), ':') = 0 THEN try_cast(trim(st) AS BIGINT) "
    "ELSE local_to_epoch(gtfs_local_datetime(try_to_date(trim(sd), 'yyyyMMdd'), st), zone) END",
    "CREATE OR REPLACE TEMPORARY FUNCTION date_key(d DATE) RETURNS INT "
    "RETURN year(d) * 10000 + month(d) * 100 + day(d)",
    "CREATE OR REPLACE TEMPORARY FUNCTION haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) "
    f"RETURNS DOUBLE RETURN {2 * EARTH_RADIUS_KM} * asin(least(1.0D, sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) "
    "+ cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
]


def register(spark: SparkSession) -> list[str]:
    for ddl in FUNCTIONS:
        spark.sql(ddl)
    return [d.split("FUNCTION ")[1].split("(")[0] for d in FUNCTIONS]
