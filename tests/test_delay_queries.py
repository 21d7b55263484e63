"""Delay questions on hand-written stars: filters, lateness ranking, punctuality, NULL handling."""
import datetime as dt

from adherence.operators import delays as A
from adherence.operators.dims import vehicle_type_dim
from adherence.operators.filters import Filters
from adherence.sources.driver import Star

FACT = ("date_key int, full_date date, route_key long, stop_key long, vehicle_type_key int, trip_id string, "
        "stop_sequence int, scheduled_arrival timestamp_ntz, actual_arrival timestamp_ntz, delay_seconds int, data_source string")


def star(spark, by_route: dict, null_name_route=None):
    facts, routes = [], []
    for rk, delays in by_route.items():
        routes.append((rk, str(rk), None if rk == null_name_route else str(rk), f"Route {rk}"))
        for i, d in enumerate(delays):
            t = dt.datetime(2026, 7, 12, 8, i)
            facts.append((20260712, dt.date(2026, 7, 12), rk, 1, 4, f"{rk}-{i}", 1, t, t, d, "gtfs_rt"))
    f = spark.createDataFrame(facts, FACT)
    r = spark.createDataFrame(routes, "route_key long, route_id string, route_short_name string, route_long_name string")
    s = spark.createDataFrame([(1, "1", "Stop", 59.3, 18.0)], "stop_key long, stop_id string, stop_name string, stop_lat double, stop_lon double")
    return Star(f, r, s, vehicle_type_dim(spark))


def test_filter_keys_and_predicate(spark):
    f = Filters(start_date="2026-07-12", end_date="2026-07-13", route_ids=("1", "2"), vehicle_types=("Bus", "Metro"))
    assert (f.start_date_key, f.end_date_key) == (20260712, 20260713)
    df = spark.createDataFrame([(20260712, "1", "Bus"), (20260714, "1", "Bus"), (20260712, "3", "Bus"),
                                (20260713, "2", "Tram")], "date_key int, route_id string, type_name string")
    assert df.filter(f.predicate()).count() == 1
    assert df.filter(Filters().predicate()).count() == 4


def test_lateness_ranking(spark):
    st = star(spark, {10: [120] * 3 + [0] * 3, 20: [30] * 6})
    got = [(r.route_short_name, r.pct_late) for r in A.route_lateness(st, min_observations=5).orderBy("rank").collect()]
    assert got == [("10", 0.5), ("20", 0.0)]


def test_lateness_min_sample(spark):
    st = star(spark, {10: [120] * 3 + [0] * 3, 99: [500]})
    got = [r.route_short_name for r in A.route_lateness(st, min_observations=3).collect()]
    assert got == ["10"]


def test_null_delay_never_zero_and_null_names_grouped(spark):
    st = star(spark, {1: [None, None, 60], 2: [10, 20]}, null_name_route=1)
    k = A.kpis(st).first()
    assert k.total_facts == 5 and k.observed_delay_count == 3
    assert abs(k.realtime_match_rate - 0.6) < 1e-12
    names = {r.route_short_name for r in A.avg_delay_by_route(st).collect()}
    assert names == {None, "2"}                                       # D16: NULL name is a group
    assert A.worst_route(st).first().worst_route is None              # highest avg is the unnamed route
    empty = star(spark, {3: [None]})
    assert A.worst_route(empty).first().worst_route == "N/A"


def test_punctuality(spark):
    st = star(spark, {1: [-120, -60, 0, 60, 120, 600]})
    s = A.punctuality_summary(st).first()
    assert s.n == 6 and abs(s.early_pct - 100 / 6) < 1e-9 and abs(s.on_time_pct - 50.0) < 1e-9
    assert A.punctuality_dominant(A.punctuality_summary(st)).first().dominant == "about on time"
    ladder = {r.within_minutes: r.percent for r in A.punctuality_ladder(A.punctuality_summary(st)).collect()}
    assert ladder[10] == 100.0
    story = A.punctuality_story(A.punctuality_summary(st)).first().story
    assert story.startswith("6 measured stop arrivals")


def test_color_range(spark):
    vals = spark.createDataFrame([(float(x),) for x in range(100)], "v double")
    r = A.robust_color_range(vals, "v").first()
    assert abs(r.color_min - (4.95 - 0.5)) < 1e-9 and abs(r.color_max - (94.05 + 0.5)) < 1e-9
    narrow = spark.createDataFrame([(1.0,), (1.2,)], "v double")
    r = A.robust_color_range(narrow, "v").first()
    assert abs(r.color_min - (1.1 - 5.5)) < 1e-9
    empty = spark.createDataFrame([], "v double")
    r = A.robust_color_range(empty, "v").first()
    assert (r.color_min, r.color_max) == (-5.0, 15.0)


def test_fmt_minutes(spark):
    df = spark.createDataFrame([(90,), (-30,), (None,)], "s int")
    assert [r.v for r in df.select(A.fmt_minutes("s").alias("v")).collect()] == ["+1.5 min", "-0.5 min", "N/A"]


def test_heatmap_pivot_and_days(spark):
    st = star(spark, {1: [60, 120]})
    hm = A.delay_heatmap(st)
    p = A.heatmap_pivot(hm).first()
    assert p.day_name == "Sun" and p.h08 == 90.0 and p.h09 is None
    assert A.days_present(hm).first().days == "Sun"


def test_energy_collapse_first_reasons(spark):
    from adherence.operators import energy as E
    v = spark.createDataFrame([
        ("27", "27", "Long", 20260712, 3, 10.0, 30.0, 1.0, 3.0, 8.0, 0.2, 90.0, True, "LONG_DISTANCE"),
        ("27", "27", "Long", 20260713, 2, 12.0, 24.0, 2.0, 4.0, 9.0, 0.1, 40.0, False, "")],
        "route_id string, route_short_name string, route_long_name string, date_key int, trip_count int, avg_km double, "
        "total_km double, p90_hours double, total_hours double, avg_stops double, delay_hours double, energy_score double, "
        "is_flagged boolean, flag_reasons string")
    c = E.collapse(v).first()
    assert c.trip_count == 5 and c.p90_hours == 2.0 and c.is_flagged is True
    assert c.flag_reasons == "LONG_DISTANCE" and c.energy_score == 65.0


def test_available_routes_nulls_last(spark):
    st = star(spark, {1: [5], 2: [6], 3: [7]}, null_name_route=1)
    got = [r.route_short_name for r in A.available_routes(st).collect()]
    assert got == ["2", "3", None]


def test_story_rounds_like_python(spark):
    s = spark.createDataFrame([(8, 12.5, 37.5, 50.0, 0.25, 1.0)],
                              "n long, early_pct double, on_time_pct double, late_pct double, median_min double, p90_min double")
    story = A.punctuality_story(s).first().story
    py = f"{8:,} measured stop arrivals: {37.5:.0f}% on time (within a minute), {12.5:.0f}% early, {50.0:.0f}% late;"
    assert story.startswith(py) and f"{0.25:+.1f} min" in story


def test_fmt_minutes_matches_python(spark):
    secs = [90, -30, 15, -3, 0, 27, 213, -213, 3]
    df = spark.createDataFrame([(s,) for s in secs], "s int")
    got = [r.v for r in df.select(A.fmt_minutes("s").alias("v")).collect()]

    def py(sec):
        m = sec / 60
        return f"{'+' if m >= 0 else ''}{m:.1f} min"
    assert got == [py(s) for s in secs]
