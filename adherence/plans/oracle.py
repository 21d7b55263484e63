"""DuckDB twins of the driver-table views, used as the independent correctness oracle.

``with_views(names, body)`` prefixes a query body with the CTEs it needs.  The expressions mirror
``adherence.sources.driver`` one for one (same mapping, written in SQL).
"""

from __future__ import annotations

from adherence.constants import VEHICLE_TYPES

_VT_VALUES = ", ".join(f"({i + 1}, {code}, '{name}')" for i, (code, name) in enumerate(VEHICLE_TYPES))

VIEWS: dict[str, str] = {
    "li_dedup": """
        SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus,
               l_shipdate, l_partkey, l_extendedprice
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_linenumber
                 ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) = 1""",
    "dim_vehicle_type": f"""
        SELECT * FROM (VALUES {_VT_VALUES}) t(vehicle_type_key, gtfs_route_type, type_name)""",
    "trips": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS full_date,
               CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key,
               o_custkey % 200 AS route_key, o_orderpriority,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '0' WHEN 'FURNITURE' THEN '1'
                    WHEN 'HOUSEHOLD' THEN '2' WHEN 'BUILDING' THEN '3' WHEN 'MACHINERY' THEN '4' END AS route_type
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "trips_vt": """
        SELECT t.*, COALESCE(vt.vehicle_type_key, 4) AS vehicle_type_key
        FROM trips t LEFT JOIN dim_vehicle_type vt
          ON vt.gtfs_route_type = COALESCE(TRY_CAST(trim(t.route_type) AS INTEGER), 3)""",
    "facts": """
        SELECT date_key, full_date, route_key, stop_key, vehicle_type_key, trip_id, stop_sequence,
               scheduled_arrival, scheduled_arrival + to_seconds(delay_seconds) AS actual_arrival,
               delay_seconds, 'gtfs_rt' AS data_source
        FROM (
          SELECT t.date_key, t.full_date, t.route_key, li.l_suppkey AS stop_key, t.vehicle_type_key,
                 CAST(li.l_orderkey AS VARCHAR) AS trip_id, li.l_linenumber AS stop_sequence,
                 CAST(t.full_date AS TIMESTAMP)
                   + to_seconds((5 + li.l_orderkey % 21) * 3600 + 7 * li.l_linenumber * 60) AS scheduled_arrival,
                 CASE WHEN li.l_returnflag = 'N' AND li.l_linestatus = 'F' THEN NULL
                      ELSE CAST((li.l_quantity - 20) * 30 AS INTEGER) END AS delay_seconds
          FROM li_dedup li JOIN trips_vt t ON li.l_orderkey = t.o_orderkey)""",
    "dim_route": """
        SELECT route_key, CAST(route_key AS VARCHAR) AS route_id,
               CASE WHEN route_key <> 0 THEN CAST(route_key AS VARCHAR) END AS route_short_name,
               'Route ' || CAST(route_key AS VARCHAR) AS route_long_name
        FROM (SELECT DISTINCT c_custkey % 200 AS route_key FROM customer)""",
    "dim_stop": """
        SELECT s_suppkey AS stop_key, CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
               CASE WHEN s_suppkey % 41 = 0 THEN NULL WHEN s_suppkey % 37 = 0 THEN 60.5
                    ELSE CAST(5920 + s_suppkey % 20 AS DOUBLE) / 100 END AS stop_lat,
               CASE WHEN s_suppkey % 41 = 0 THEN NULL
                    ELSE CAST(1790 + s_suppkey % 30 AS DOUBLE) / 100 END AS stop_lon
        FROM supplier""",
    "wide": """
        SELECT f.*, r.route_id, r.route_short_name, r.route_long_name,
               s.stop_id, s.stop_name, s.stop_lat, s.stop_lon, vt.type_name,
               CAST(isodow(f.full_date) AS INTEGER) AS day_of_week,
               strftime(f.full_date, '%a') AS day_name,
               CAST(hour(f.scheduled_arrival) AS INTEGER) AS hour_of_day
        FROM facts f
        JOIN dim_route r ON f.route_key = r.route_key
        JOIN dim_stop s ON f.stop_key = s.stop_key
        JOIN dim_vehicle_type vt ON f.vehicle_type_key = vt.vehicle_type_key""",
    "measured": """
        SELECT * FROM wide WHERE delay_seconds IS NOT NULL""",
}

# dependency order
_ORDER = ["li_dedup", "dim_vehicle_type", "trips", "trips_vt", "facts", "dim_route", "dim_stop", "wide", "measured"]
_DEPS = {
    "trips_vt": ["trips", "dim_vehicle_type"],
    "facts": ["li_dedup", "trips_vt"],
    "wide": ["facts", "dim_route", "dim_stop", "dim_vehicle_type"],
    "measured": ["wide"],
}


def _closure(names) -> list[str]:
    need: set[str] = set()

    def add(n):
        if n in need:
            return
        need.add(n)
        for d in _DEPS.get(n, []):
            add(d)

    for n in names:
        add(n)
    return [n for n in _ORDER if n in need]


def with_views(names, body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in _closure(names)]
    for name, sql in extra or []:
        ctes.append(f"{name} AS ({sql}\n)")
    return "WITH " + ",\n".join(ctes) + "\n" + body
