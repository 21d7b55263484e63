"""Energy score golden values (E1-E11, P8, P9) on hand-written rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from adherence.functions.geo import haversine_km
from adherence.operators import energy as E

ROW = ("date_key int, route_key long, vehicle_type_key int, trip_id string, stop_sequence int, stop_key long, "
       "scheduled_arrival timestamp_ntz, actual_arrival timestamp_ntz, delay_seconds int, stop_lat double, stop_lon double")
T0 = dt.datetime(2026, 7, 12, 8, 0)


def rows(spark, pts, trip="t1", route=1, actual=None, delays=None, sched_step=None):
    out = []
    for i, (lat, lon) in enumerate(pts):
        sched = T0 + (sched_step or dt.timedelta(minutes=10)) * i
        act = actual[i] if actual else None
        d = delays[i] if delays else None
        out.append((20260712, route, 4, trip, i + 1, 100 + i, sched, act, d, lat, lon))
    return spark.createDataFrame(out, ROW)


def test_haversine_short_hop(spark):
    v = spark.range(1).select(haversine_km(F.lit(59.33), F.lit(18.06), F.lit(59.34), F.lit(18.06)).alias("v")).first().v
    assert 1.0 < v < 1.3


def test_one_point_path_is_zero_and_dropped(spark):
    g = E.trip_geometry(rows(spark, [(59.33, 18.06)])).first()
    assert g.km == 0.0 and g.n_stops == 1
    assert E.trip_features(rows(spark, [(59.33, 18.06)])).count() == 0


def test_long_leg_dropped_and_unlocated_skipped(spark):
    pts = [(59.33, 18.06), (None, None), (59.34, 18.06), (60.5, 18.06)]
    g = E.trip_geometry(rows(spark, pts)).first()
    short = spark.range(1).select(haversine_km(F.lit(59.33), F.lit(18.06), F.lit(59.34), F.lit(18.06))).first()[0]
    assert g.n_stops == 3
    assert g.km == pytest.approx(short)  # 59.34 -> 60.5 is > 25 km and dropped


@pytest.mark.parametrize("actual,step,expected", [
    (None, dt.timedelta(minutes=30), 1.0),                                   # scheduled 1 h
    ([T0, None, T0 + dt.timedelta(hours=2)], dt.timedelta(minutes=30), 2.0),  # actual ends: 2 h
    (None, dt.timedelta(hours=6), 8.0),                                       # 12 h capped at 8
])
def test_duration(spark, actual, step, expected):
    pts = [(59.33, 18.06), (59.335, 18.06), (59.34, 18.06)]
    g = E.trip_geometry(rows(spark, pts, actual=actual, sched_step=step)).first()
    assert g.hours == pytest.approx(expected)


def test_region_share(spark):
    inner = (59.33, 18.06)
    outside = (59.50, 18.50)
    def member(pts):
        m = E.region_membership(E.trip_geometry(rows(spark, pts)))
        return {r.region_id: r.in_region for r in m.collect()}
    assert member([inner, inner])["inner_stockholm"] is True
    assert member([outside, outside])["inner_stockholm"] is False
    assert member([inner, outside])["inner_stockholm"] is True       # half is enough
    assert member([outside, outside])["all"] is True                  # no box
    both = member([(59.305, 18.0), (59.305, 18.0)])                   # overlapping boxes (D22)
    assert both["inner_stockholm"] and both["south_stockholm"]


def _routes(spark, raws, **extra):
    base = dict(avg_km=1.0, p90_hours=1.0, avg_stops=5.0, delay_hours=0.1, total_hours=1.0, trip_count=1)
    base.update(extra)
    data = [(20260712, "all", "All stops", i, 4, base["trip_count"], base["avg_km"], base["total_hours"],
             base["p90_hours"], base["avg_stops"], base["delay_hours"], float(r), base["avg_km"])
            for i, r in enumerate(raws)]
    return spark.createDataFrame(data, "date_key int, region_id string, region_name string, route_key long, "
                                       "vehicle_type_key int, trip_count int, total_km double, total_hours double, "
                                       "p90_hours double, avg_stops double, delay_hours double, raw_score double, avg_km double")


def test_min_max_scale(spark):
    flat = sorted(r.energy_score for r in E.route_scores(_routes(spark, [1, 1, 1])).collect())
    assert flat == [50.0, 50.0, 50.0]
    spread = sorted(r.energy_score for r in E.route_scores(_routes(spark, [0, 5, 10])).collect())
    assert spread == [0.0, 50.0, 100.0]


def test_percentile_linear_interpolation(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 10.0, 20.0, 30.0]], "x double")
    assert df.agg(F.percentile("x", 0.5)).first()[0] == 15.0
    assert spark.createDataFrame([(10.0,)], "x double").agg(F.percentile("x", 0.9)).first()[0] == 10.0


def test_raw_score(spark):
    v = spark.range(1).select(E.raw_score(F.lit(10.0), F.lit(1.0), F.lit(20), F.lit(0.5)).alias("v")).first().v
    assert v == pytest.approx(7.90)


def test_all_reason_tags_and_flag(spark):
    # one route far above three small peers on every metric
    data = [(20260712, "all", "All stops", i, 4, 1, 1.0, 0.5, 0.5, 2.0, 0.01, 1.0, 1.0) for i in range(3)]
    data.append((20260712, "all", "All stops", 9, 4, 50, 500.0, 100.0, 6.0, 400.0, 40.0, 99.0, 10.0))
    df = spark.createDataFrame(data, "date_key int, region_id string, region_name string, route_key long, "
                                     "vehicle_type_key int, trip_count int, total_km double, total_hours double, "
                                     "p90_hours double, avg_stops double, delay_hours double, raw_score double, avg_km double")
    top = [r for r in E.route_scores(df).collect() if r.route_key == 9][0]
    assert top.flag_reasons == ",".join(["LONG_DISTANCE", "LONG_DURATION", "HIGH_STOP_DENSITY", "CONGESTION",
                                         "HIGH_FREQUENCY", "SLOW_SPEED"])
    assert top.is_flagged is True and top.energy_score == 100.0
