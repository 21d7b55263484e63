"""Timetable ⋈ realtime matching.

Inputs are GTFS tables as read from CSV (all strings) and flat TripUpdates rows (S5 shape).

Shuffle plan of ``scheduled``: the only large join is stop_times ⋈ trips on ``trip_id`` (J3);
the trip start (W1) is a window over that same key, so it needs no further shuffle, and the
timetable is read once.  Stops and routes are joined without hints (AQE decides from runtime sizes).

The fallback match (J8) joins on (route_id, stop_id, stop_sequence) with a ±300 s band on trip
start, within one service day.  Instead of pairing every scheduled and realtime trip of a stop and
filtering, start times are bucketed by twice the band and each realtime row probes the one or two
buckets that its band reaches.  Rows with a NULL start on either side match whatever the other's
start (the source semantics) on the same day, in joins of their own that a feed without such rows
doesn't have.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adherence.constants import DEFAULT_ZONE, FALLBACK_START_BAND_SEC, REALTIME_FEED_REGIONAL
from adherence.functions import delay as DL
from adherence.functions import gtfs_time as T
from adherence.functions.ids import as_key_string, operator_agency_predicate, rt_stop_id, uniform
from adherence.operators.dims import join_dim
from adherence.session import materialized

#: Rows of one key that a task may get from a side of the fallback match; keys that a broadcast may name.
HOT_ROWS, BROADCAST_KEYS = 100_000, 200_000
#: Buckets of keys whose rows are counted first.
KEY_BUCKETS = 1 << 20


class NoMatchError(ValueError):
    """Neither the primary nor the fallback match produced a row."""


@dataclass
class Gtfs:
    """GTFS static tables as string DataFrames.  ``trips`` may carry a ``service_date`` column
    (one service date per trip); otherwise pass ``service_date`` to ``scheduled``."""

    agency: DataFrame | None
    routes: DataFrame
    trips: DataFrame
    stops: DataFrame
    stop_times: DataFrame


def select_operator(g: Gtfs, static_feed: str) -> tuple[DataFrame, DataFrame]:
    """P1 + J1 + J2: (selected routes, selected trips).  Agencies and routes are dimension-sized;
    the semi joins only filter."""
    if g.agency is None or static_feed == REALTIME_FEED_REGIONAL:
        return g.routes, g.trips  # a per-operator feed holds nothing else
    agencies = g.agency.filter(operator_agency_predicate(static_feed)).select("agency_id").distinct()
    routes = g.routes.join(agencies, "agency_id", "left_semi")
    return routes, join_dim(g.trips, routes.select("route_id"), "route_id", how="left_semi")


def sample_trips(trips: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """P10 + J10: deterministic hash sample of trips (the same subset on every recompute, D19);
    the stop_times of sampled trips follow through the trip join."""
    if not 0 < fraction < 1:
        raise ValueError("sample fraction must be in (0, 1)")
    return trips.filter(uniform(F.lit(str(seed)), F.col("trip_id").cast("string")) < fraction)


def operator_stop_times(g: Gtfs, static_feed: str, sample_fraction: float | None = None) -> DataFrame:
    """stop_times of the selected trips, with route_id and service_date; keys as strings."""
    _, trips = select_operator(g, static_feed)
    if sample_fraction:
        trips = sample_trips(trips, sample_fraction)  # J10 is subsumed: the semi join below filters
    keep = ["trip_id", "route_id"] + (["service_date"] if "service_date" in trips.columns else [])
    st = g.stop_times.join(trips.select(*keep), "trip_id")
    return st.withColumns({c: as_key_string(F.col(c)) for c in ("route_id", "stop_id", "trip_id", "stop_sequence")})


def trip_starts(stop_times: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Departure of the first stop (lowest integer stop_sequence) of each trip -> local start
    and epoch.

    An aggregate on the trip key; the service date is constant per trip."""
    first = stop_times.groupBy("trip_id").agg(_first_stop().alias("_p"), F.max("service_date").alias("service_date"))
    local = T.local_datetime(F.col("service_date"), F.col("_p.secs"))
    return first.select("trip_id", local.alias("trip_start_ts"), T.local_to_epoch(local, zone).alias("trip_start_epoch"))


def _first_stop():
    """Minimum of (sequence, departure): an unparsable departure comes last within its sequence, a stop
    without a sequence doesn't count."""
    seq, secs = F.col("stop_sequence").try_cast("int"), T.gtfs_time_to_seconds("departure_time")
    return F.min(F.when(seq.isNotNull(), F.struct(seq.alias("seq"), secs.isNull().alias("none"), secs.alias("secs"))))


def scheduled(g: Gtfs, static_feed: str, service_date: str | None = None, zone: str = DEFAULT_ZONE,
              sample_fraction: float | None = None) -> DataFrame:
    """The scheduled stop visits with names, coordinates, local arrival and epochs."""
    st = operator_stop_times(g, static_feed, sample_fraction)
    if service_date is not None:
        st = st.withColumn("service_date", F.lit(service_date).cast("date"))
    # W1 over J3's own partitioning: a trip's visits are few, and lie in one partition already
    start = T.local_datetime(F.col("service_date"), F.col("_first.secs"))
    st = st.withColumn("_first", _first_stop().over(Window.partitionBy("trip_id")))
    st = st.withColumn("trip_start_epoch", T.local_to_epoch(start, zone)).drop("_first")
    stops = g.stops.select(as_key_string(F.col("stop_id")).alias("stop_id"), "stop_name", "stop_lat", "stop_lon")
    routes = g.routes.select(as_key_string(F.col("route_id")).alias("route_id"), "route_short_name",
                             "route_long_name", "route_type")
    s = join_dim(st, stops, "stop_id")
    s = join_dim(s, routes, "route_id")
    arr = T.gtfs_time_to_datetime(F.col("service_date"), F.col("arrival_time"))
    return s.select(
        "trip_id", "stop_id", "stop_sequence", "route_id", "route_short_name", "route_long_name", "route_type",
        "stop_name", T.parse_coordinate("stop_lat").alias("stop_lat"), T.parse_coordinate("stop_lon").alias("stop_lon"),
        "service_date", arr.alias("scheduled_arrival"), T.local_to_epoch(arr, zone).alias("scheduled_epoch"),
        "trip_start_epoch",
    )


def prepare_realtime(rt: DataFrame, static_feed: str, realtime_feed: str) -> DataFrame:
    """P2 + P3 + F8: translated, non-blank stop ids; keys as strings."""
    keys = {c: as_key_string(F.col(c)) for c in ("route_id", "trip_id", "stop_sequence")}
    keys["stop_id"] = rt_stop_id(F.col("stop_id"), static_feed, realtime_feed)
    return rt.withColumns(keys).filter(F.col("stop_id").isNotNull())


def match_primary(sched: DataFrame, rt: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """Inner on (trip_id, stop_id); the schedule's stop_sequence is kept (D7 fan-out kept).
    ``keep_unmatched`` (D5 option) keeps scheduled visits without realtime as NULL-delay rows."""
    extra = [F.col("stop_sequence").alias("rt_stop_sequence")] + [c for c in ("snapshot_ts",) if c in rt.columns]
    r = rt.select("trip_id", "stop_id", "delay_seconds", "actual_epoch", *extra)
    return sched.join(r, ["trip_id", "stop_id"], "left" if keep_unmatched else "inner")


def same_service_day(rt: DataFrame, service_date: str) -> DataFrame:
    """D6 option: drop realtime trips whose start_date names another service day (absent = kept)."""
    day = F.date_format(F.lit(service_date).cast("date"), "yyyyMMdd")
    return rt.filter(F.col("start_date").isNull() | (F.col("start_date") == day))


def active_services(calendar: DataFrame | None, calendar_dates: DataFrame | None, service_date: str) -> DataFrame:
    """D6 option: service_ids running on ``service_date`` from calendar.txt (weekday flag inside the
    start/end range) plus calendar_dates additions (type 1) minus removals (type 2)."""
    d = F.lit(service_date).cast("date")
    ymd = F.date_format(d, "yyyyMMdd")
    weekday = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    flag = None
    for i, name in enumerate(weekday):
        flag = (F.when(T.iso_day_of_week(d) == i + 1, F.col(name)) if flag is None
                else flag.when(T.iso_day_of_week(d) == i + 1, F.col(name)))
    parts = []
    if calendar is not None:
        parts.append(calendar.filter((F.col("start_date") <= ymd) & (F.col("end_date") >= ymd) & (flag == "1"))
                     .select("service_id"))
    if calendar_dates is not None:
        cd = calendar_dates.filter(F.col("date") == ymd)
        parts.append(cd.filter(F.col("exception_type") == "1").select("service_id"))
    base = parts[0]
    for p in parts[1:]:
        base = base.unionByName(p)
    base = base.distinct()
    if calendar_dates is not None:
        removed = calendar_dates.filter((F.col("date") == ymd) & (F.col("exception_type") == "2")).select("service_id")
        base = base.join(removed, "service_id", "left_anti")
    return base


def running_trips(trips: DataFrame, services: DataFrame) -> DataFrame:
    """Trips whose service runs that day (semi join against a dimension-sized id list)."""
    return trips.join(services, "service_id", "left_semi")


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner equi-join of stored frames whose keys may hold any share of the rows.

    Rows are counted first, by ``KEY_BUCKETS`` hashes of the key, of which a task sends one number each; and in
    the buckets that hold more than ``hot_rows`` of a side, by the key.  A key with more than ``hot_rows`` on a side is dealt over a
    grid: its left rows are split over so many strips, its right rows over so many, each row is copied once
    for each strip of the other side, and every pair meets in exactly one cell of at most about
    ``hot_rows`` by ``hot_rows``.  Without such a key it is the plain join, and no row is copied."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).alias("_bucket")
    full = [f.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select("_bucket") for f in (left, right)]
    full = materialized(full[0].unionByName(full[1]).distinct(), "full-buckets")  # KEY_BUCKETS rows at most
    if full.isEmpty():
        return left.join(right, keys)
    counts = [f.withColumn("_bucket", bucket).join(F.broadcast(full), "_bucket", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
              for f, n in ((left, "_nl"), (right, "_nr"))]
    hot = counts[0].join(counts[1], keys).where(f"_nl > {hot_rows} or _nr > {hot_rows}")
    hot = materialized(hot.select(*keys, F.ceil(F.col("_nl") / hot_rows).cast("int").alias("_strips"), F.ceil(F.col("_nr") / hot_rows).cast("int").alias("_lanes")), "hot-keys")
    n_hot = hot.limit(BROADCAST_KEYS + 1).count()  # at most the rows of both sides over hot_rows
    if not n_hot:
        return left.join(right, keys)
    marked = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    other = F.sequence(F.lit(0), F.col("_copies") - 1)

    def dealt(side: DataFrame, mine: str, theirs: str, own_name: str, other_name: str) -> DataFrame:
        # numbered where they are stored, so a task that runs again deals its rows alike
        out = side.withColumn("_row", F.monotonically_increasing_id()).join(marked, keys, "left")
        out = out.withColumns({own_name: F.pmod("_row", F.coalesce(mine, F.lit(1))).cast("int"), "_copies": F.coalesce(theirs, F.lit(1))})
        return out.withColumn(other_name, F.explode(other)).drop("_row", "_copies", "_strips", "_lanes")

    grid = [dealt(left, "_strips", "_lanes", "_strip", "_lane"), dealt(right, "_lanes", "_strips", "_lane", "_strip")]
    return grid[0].join(grid[1], [*keys, "_strip", "_lane"]).drop("_strip", "_lane")


def match_fallback(sched: DataFrame, rt: DataFrame, band: int = FALLBACK_START_BAND_SEC,
                   default_date: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner on (service day, route_id, stop_id, stop_sequence) where either start is NULL or the
    starts differ by at most ``band`` seconds; the realtime trip_id is discarded.

    A realtime row's day is its start_date, or ``default_date`` (the day of a daily job) where it has
    none; a row without either has no day to match.

    Three disjoint parts.  Both starts known: an equi-join on the keys and a bucket of starts; buckets are
    twice as wide as the band, so a realtime row probes the one or two that its band reaches.  A scheduled
    row without a start meets all realtime rows of its keys; a realtime row without one meets the scheduled
    rows that have a start.  Both sides are stored and looked at first: the second and third part are
    in the plan only if there are such rows, so without any no row is copied for them, and keys that hold
    very many of the rows are dealt over tasks (``spread_join``)."""
    keys = ["service_date", "route_id", "stop_id", "stop_sequence"]
    day = F.to_date(F.col("start_date"), "yyyyMMdd") if "start_date" in rt.columns else F.lit(None).cast("date")
    if default_date is not None:
        day = F.coalesce(day, F.lit(default_date).cast("date"))
    s = materialized(sched, "scheduled")
    r = materialized(rt.select(day.alias("service_date"), *keys[1:], F.col("trip_start_epoch").alias("rt_trip_start_epoch"), "delay_seconds", "actual_epoch"), "realtime")
    s_start, r_start = F.col("trip_start_epoch"), F.col("rt_trip_start_epoch")
    width = 2 * band
    probes = F.array_distinct(F.array(F.floor((r_start - band) / width), F.floor((r_start + band) / width)))
    timed = spread_join(s.where(s_start.isNotNull()).withColumn("_b", F.floor(s_start / width)),
                        r.where(r_start.isNotNull()).withColumn("_b", F.explode(probes)), [*keys, "_b"], hot_rows)
    out = timed.where(F.abs(r_start - s_start) <= band).drop("_b")
    for left, right in ((s.where(s_start.isNull()), r), (s.where(s_start.isNotNull()), r.where(r_start.isNull()))):
        if not (left if right is r else right).isEmpty():
            out = out.unionByName(spread_join(left, right, keys, hot_rows))
    return out


def match(sched: DataFrame, rt: DataFrame, band: int = FALLBACK_START_BAND_SEC, default_date: str | None = None,
          keep_unmatched: bool = False) -> tuple[DataFrame, str]:
    """The primary match unless it is empty, then the fallback; both empty is an error.

    The emptiness test is one cheap limit-1 job; Catalyst cannot express a data-dependent plan
    switch, so the branch happens on the driver with nothing but a boolean."""
    primary = match_primary(sched, rt)
    if not primary.isEmpty():
        return match_primary(sched, rt, keep_unmatched), "primary"
    fallback = match_fallback(sched, rt, band, default_date)
    visit = [c for c in fallback.columns if c in sched.columns]
    # looked at, then loaded; the schedule's side in one column, of which later steps read what they need
    kept = materialized(fallback.select(F.struct(*visit).alias("visit"), *[c for c in fallback.columns if c not in visit]), "fallback")
    if kept.isEmpty():
        raise NoMatchError("no rows after matching the schedule with realtime updates")
    return kept.select(*[F.col(f"visit.{c}").alias(c) if c in visit else c for c in fallback.columns]), "fallback"


def derive(matched: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """actual arrival (realtime time, else scheduled + delay) and delay (realtime delay,
    else actual - scheduled), in epochs; the local NTZ actual arrival for display and hour()."""
    act = DL.actual_epoch(F.col("actual_epoch"), F.col("scheduled_epoch"), F.col("delay_seconds"))
    out = matched.withColumn("actual_epoch", act).withColumn(
        "delay_seconds", DL.delay_seconds(F.col("delay_seconds"), F.col("actual_epoch"), F.col("scheduled_epoch")))
    return out.withColumn("actual_arrival", T.epoch_to_local(F.col("actual_epoch"), zone))


def referenced_stops(stops: DataFrame, stop_times: DataFrame) -> DataFrame:
    """J11 + U1: the stops a schedule uses (distinct ids reduced map-side, then a semi join)."""
    used = stop_times.select("stop_id").distinct()
    return stops.join(used, "stop_id", "left_semi").select("stop_id", "stop_name", "stop_lat", "stop_lon").distinct()


def id_overlap(static: DataFrame, realtime: DataFrame) -> DataFrame:
    """Per id kind, distinct ids in the static feed, in realtime, and in both, from rows of
    (id_kind, id) on each side: one pass over each, one full outer join, one aggregate."""
    a = static.filter(F.col("id").isNotNull()).distinct().withColumn("_s", F.lit(True))
    b = realtime.filter(F.col("id").isNotNull()).distinct().withColumn("_r", F.lit(True))
    seen_s, seen_r = F.col("_s").isNotNull(), F.col("_r").isNotNull()
    return a.join(b, ["id_kind", "id"], "full_outer").groupBy("id_kind").agg(
        F.count_if(seen_s).alias("static_ids"), F.count_if(seen_r).alias("realtime_ids"), F.count_if(seen_s & seen_r).alias("common_ids"))


def ids_of(df: DataFrame, kinds: list[str]) -> DataFrame:
    """(id_kind, id) rows of the id columns of a frame, read once."""
    pairs = F.array(*[F.struct(F.lit(k).alias("id_kind"), F.col(k).cast("string").alias("id")) for k in kinds])
    return df.select(F.explode(pairs).alias("p")).select("p.*")
