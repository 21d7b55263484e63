"""The driver's TPC-H-like tables seen as transit data (the bench views).

Mapping (same expressions as the DuckDB oracle in ``adherence.plans.oracle``):

* trip = order (``trip_id = l_orderkey``), stop visit = lineitem, stop = supplier,
  route = ``o_custkey % 200``, vehicle type from the customer's market segment,
  service date = ``o_orderdate``.
* GTFS time of a stop visit: hour ``5 + l_orderkey % 21`` (up to 25, so post-midnight times
  occur), minute ``7 * l_linenumber``.
* delay: NULL when ``l_returnflag = 'N' and l_linestatus = 'F'``, else ``(l_quantity - 20) * 30``.
* realtime feed: every lineitem row (natural duplicates included); the updates of line 7 of finished
  lines name a stop id that the timetable lacks (``x`` before it); returnflag R carries only a time, A only a delay, N/F neither.

Every view is lazy; nothing is collected.  Grain duplicates are collapsed with an aggregate
(``max`` of a struct led by the total order) so map-side partial aggregation shrinks a hot key
before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.constants import DEFAULT_ZONE, FACT_DATA_SOURCE
from adherence.functions import gtfs_time as T
from adherence.operators import dims as D
from adherence.session import by_rows

ROUTES = 200
# fixed mapping of this fixture (our own, not the reference's): market segment -> GTFS route_type
SEGMENT_ROUTE_TYPE = {
    "AUTOMOBILE": "0",
    "FURNITURE": "1",
    "HOUSEHOLD": "2",
    "BUILDING": "3",
    "MACHINERY": "4",
}


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def stop_visits(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """lineitem, hashed by trip: the grain contains the trip, so the de-duplication, the trip join and
    the trip start all work on this one exchange.  A trip is a bounded number of visits; the number of
    partitions follows the rows, which the files' footers tell."""
    li = read(spark, sf_dir, "lineitem", *cols)
    return by_rows(li.withColumn("trip_id", F.col("l_orderkey").cast("string")), li.count(), "trip_id")


def _segment_route_type(seg: Column) -> Column:
    expr = None
    for k, v in SEGMENT_ROUTE_TYPE.items():
        expr = (F.when(seg == k, F.lit(v)) if expr is None else expr.when(seg == k, F.lit(v)))
    return expr


def sched_seconds(orderkey: Column, linenumber: Column) -> Column:
    return ((F.lit(5) + orderkey % 21) * 3600 + F.lit(7) * linenumber * 60).cast("int")


def gtfs_time_text(seconds: Column) -> Column:
    """Seconds after midnight -> ``HH:MM:SS`` (hours may exceed 23)."""
    return F.format_string(
        "%02d:%02d:%02d", (seconds / 3600).cast("int"), ((seconds % 3600) / 60).cast("int"), seconds % 60
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip from orders alone (no vehicle type, so no customer join)."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return o.select(
        F.col("o_orderkey"),
        F.to_date("o_orderdate").alias("full_date"),
        T.date_key(F.col("o_orderdate")).alias("date_key"),
        (F.col("o_custkey") % ROUTES).alias("route_key"),
        F.col("o_orderpriority"),
    )


def by_trip(orders: DataFrame) -> DataFrame:
    return orders.withColumn("trip_id", F.col("o_orderkey").cast("string")).drop("o_orderkey")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip (order): service date, route, route_type text."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey"),
        F.to_date("o_orderdate").alias("full_date"),
        T.date_key(F.col("o_orderdate")).alias("date_key"),
        (F.col("o_custkey") % ROUTES).alias("route_key"),
        _segment_route_type(F.col("c_mktsegment")).alias("route_type"),
        F.col("o_orderpriority"),
    )


def dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 on the raw stop visits: one row per grain (l_orderkey, l_suppkey, l_linenumber); the
    winner is first under ``l_shipdate desc, l_partkey desc, l_extendedprice desc, l_quantity
    desc`` (a total order on this data).  ``dup_count`` keeps how many rows were collapsed."""
    li = stop_visits(
        spark, sf_dir,
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    best = F.max(
        F.struct("l_shipdate", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus")
    ).alias("w")
    return (
        li.groupBy("trip_id", "l_orderkey", "l_suppkey", "l_linenumber")
        .agg(best, F.count(F.lit(1)).alias("n_rows"))
        .select("trip_id", "l_orderkey", "l_suppkey", "l_linenumber", "w.*", (F.col("n_rows") - 1).alias("dup_count"))
    )


def _delay(qty: Column, rflag: Column, lstatus: Column) -> Column:
    return F.when((rflag == "N") & (lstatus == "F"), F.lit(None).cast("int")).otherwise(
        ((qty - 20) * 30).cast("int")
    )


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stop_visits(
        spark, sf_dir,
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
    )


def facts(spark: SparkSession, sf_dir: str, vehicle_types: DataFrame | None = None, dedupe: bool = True, counts: bool = False) -> DataFrame:
    """``fact_trip_delay`` shape (natural keys double as surrogate keys here).

    ``dedupe=False`` gives the candidate rows before W3 (grain duplicates included); ``counts`` adds
    ``n_rows``, how many of them each fact stands for."""
    li = dedup_lineitem(spark, sf_dir) if dedupe else raw_lineitem(spark, sf_dir)
    t = trips(spark, sf_dir)
    vt = vehicle_types if vehicle_types is not None else D.vehicle_type_dim(spark)
    t = D.lookup_vehicle_type(t, vt, F.col("route_type"))
    secs = sched_seconds(F.col("l_orderkey"), F.col("l_linenumber"))
    delay = _delay(F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linestatus"))
    sched = T.local_datetime(F.col("full_date"), secs)
    return li.join(by_trip(t), "trip_id").select(
        "date_key",
        "full_date",
        "route_key",
        F.col("l_suppkey").alias("stop_key"),
        "vehicle_type_key",
        "trip_id",
        F.col("l_linenumber").alias("stop_sequence"),
        sched.alias("scheduled_arrival"),
        F.timestamp_add("SECOND", delay, sched).alias("actual_arrival"),
        delay.alias("delay_seconds"),
        F.lit(FACT_DATA_SOURCE).alias("data_source"),
        *([(F.col("dup_count") + 1).alias("n_rows")] if counts else []),
    )


def route_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_route: at most ``ROUTES`` rows by construction; route 0 carries no short name."""
    c = read(spark, sf_dir, "customer", "c_custkey")
    k = (F.col("c_custkey") % ROUTES).alias("route_key")
    return c.select(k).distinct().select(
        "route_key",
        F.col("route_key").cast("string").alias("route_id"),
        F.when(F.col("route_key") != 0, F.col("route_key").cast("string")).alias("route_short_name"),
        F.concat(F.lit("Route "), F.col("route_key").cast("string")).alias("route_long_name"),
    )


def stop_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_stop from supplier; some stops have no coordinates, some lie far north (> 25 km legs)."""
    s = read(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    k = F.col("s_suppkey")
    no_xy = k % 41 == 0
    lat = F.when(no_xy, F.lit(None).cast("double")).when(k % 37 == 0, F.lit(60.5)).otherwise(
        (F.lit(5920) + k % 20).cast("double") / 100
    )
    lon = F.when(no_xy, F.lit(None).cast("double")).otherwise((F.lit(1790) + k % 30).cast("double") / 100)
    return s.select(
        k.alias("stop_key"),
        k.cast("string").alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        lat.alias("stop_lat"),
        lon.alias("stop_lon"),
    )


@dataclass
class Star:
    """Fact table plus its dimensions."""

    facts: DataFrame
    routes: DataFrame
    stops: DataFrame
    vehicle_types: DataFrame


def star(spark: SparkSession, sf_dir: str) -> Star:
    vt = D.vehicle_type_dim(spark)
    return Star(
        facts=facts(spark, sf_dir, vt),
        routes=route_dim(spark, sf_dir),
        stops=stop_dim(spark, sf_dir),
        vehicle_types=vt,
    )


# ---------------------------------------------------------------- schedule / realtime side


def schedule_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stop_times.txt shape (all strings, as read from GTFS CSV) plus route_id and service date."""
    li = stop_visits(spark, sf_dir, "l_orderkey", "l_suppkey", "l_linenumber").distinct()
    t = order_trips(spark, sf_dir).select("o_orderkey", "route_key", "full_date")
    secs = sched_seconds(F.col("l_orderkey"), F.col("l_linenumber"))
    txt = gtfs_time_text(secs)
    return li.join(by_trip(t), "trip_id").select(
        "trip_id",
        F.col("route_key").cast("string").alias("route_id"),
        F.col("l_suppkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("string").alias("stop_sequence"),
        txt.alias("arrival_time"),
        txt.alias("departure_time"),
        F.col("full_date").alias("service_date"),
    )


def rt_trip_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TripDescriptor of each realtime trip: start_date yyyymmdd and a start_time that is 0-6
    minutes off the schedule's first departure (so the fallback band is exercised both ways);
    low-priority orders carry no start_time."""
    t = order_trips(spark, sf_dir)
    start_secs = (F.lit(5) + F.col("o_orderkey") % 21) * 3600 + (F.col("o_orderkey") % 7) * 60
    return t.select(
        "o_orderkey", "route_key", "full_date",
        F.date_format("full_date", "yyyyMMdd").alias("start_date"),
        F.when(F.col("o_orderpriority") != "5-LOW", gtfs_time_text(start_secs)).alias("start_time"),
    )


def realtime_updates(spark: SparkSession, sf_dir: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Flat TripUpdates rows (S5 output shape) derived from lineitem, duplicates included."""
    li = raw_lineitem(spark, sf_dir)
    # updates of line 7 of finished lines name a stop that the timetable doesn't have
    unknown = (F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "F")
    stop = F.col("l_suppkey").cast("string")
    t = rt_trip_descriptors(spark, sf_dir)
    rflag, lstatus = F.col("l_returnflag"), F.col("l_linestatus")
    secs = sched_seconds(F.col("l_orderkey"), F.col("l_linenumber"))
    sched_epoch = T.local_to_epoch(T.local_datetime(F.col("full_date"), secs), zone)
    d = ((F.col("l_quantity") - 20) * 30).cast("int")
    neither = (rflag == "N") & (lstatus == "F")
    return li.join(by_trip(t), "trip_id").select(
        "trip_id",
        F.col("route_key").cast("string").alias("route_id"),
        T.rt_start_to_epoch(F.col("start_date"), F.col("start_time"), zone).alias("trip_start_epoch"),
        "start_date",
        F.when(unknown, F.concat(F.lit("x"), stop)).otherwise(stop).alias("stop_id"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.when(~neither & (rflag != "R"), d).alias("delay_seconds"),
        F.when(~neither & (rflag != "A"), sched_epoch + d).alias("actual_epoch"),
    )


def _agency_id(k: Column) -> Column:
    """nation key -> agency id; nations 0 and 1 carry the operator's regional ids."""
    return F.when(k == 0, F.lit("275")).when(k == 1, F.lit("1:275")).otherwise(k.cast("string"))


def agency_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.select(_agency_id(F.col("n_nationkey")).alias("agency_id"), F.col("n_name").alias("agency_name"))


def routes_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """routes.txt (strings): agency by ``route_key % 25``; route_type text with blanks and an
    unknown code among the numeric ones, as real feeds have."""
    r = route_dim(spark, sf_dir)
    k = F.col("route_key")
    rtype = F.when(k % 10 == 9, F.lit("")).when(k % 10 == 8, F.lit("715")).otherwise((k % 5).cast("string"))
    return r.select(
        "route_id",
        _agency_id(k % 25).alias("agency_id"),
        F.coalesce("route_short_name", F.lit("")).alias("route_short_name"),
        "route_long_name",
        rtype.alias("route_type"),
    )


def trips_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        (F.col("o_custkey") % ROUTES).cast("string").alias("route_id"),
        F.to_date("o_orderdate").alias("service_date"),
    )


def stops_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stop_dim(spark, sf_dir)
    return s.select(
        "stop_id", "stop_name",
        F.coalesce(F.col("stop_lat").cast("string"), F.lit("")).alias("stop_lat"),
        F.coalesce(F.col("stop_lon").cast("string"), F.lit("")).alias("stop_lon"),
    )


def stop_times_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule_stop_times(spark, sf_dir).select(
        "trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time")


def gtfs(spark: SparkSession, sf_dir: str):
    from adherence.operators.match import Gtfs

    return Gtfs(
        agency=agency_txt(spark, sf_dir),
        routes=routes_txt(spark, sf_dir),
        trips=trips_txt(spark, sf_dir),
        stops=stops_txt(spark, sf_dir),
        stop_times=stop_times_txt(spark, sf_dir),
    )


def quality_facts(facts_df: DataFrame) -> DataFrame:
    """Facts with defects injected by expression, so the data-quality checks have something to
    find: delays x20 on trips whose id is divisible by 97 (out of range), and no trip id on trips
    divisible by 101.  Rows are never dropped."""
    k = F.col("trip_id").cast("bigint")
    return facts_df.withColumn(
        "delay_seconds", F.when(k % 97 == 0, F.col("delay_seconds") * 20).otherwise(F.col("delay_seconds"))
    ).withColumn("trip_id", F.when(k % 101 != 0, F.col("trip_id")))


def loaded_stop_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stop dimension in which the stops of suppliers with a negative balance have another key
    (its negative), which leaves orphan facts for the referential checks.  No row is left out."""
    s = read(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal")
    d = stop_dim(spark, sf_dir).join(s, F.col("stop_key") == F.col("s_suppkey"))
    return d.withColumn("stop_key", F.when(F.col("s_acctbal") < 0, -F.col("stop_key")).otherwise(F.col("stop_key"))).drop("s_suppkey", "s_acctbal")
