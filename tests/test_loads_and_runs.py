"""Loads (L5, L8/D23), run log (L6, L7, W4), CSV exchange (S12, S14, S15), synthetic facts (S16),
dimension merge (L3/L4) and calendar (L1)."""
import datetime as dt

from pyspark.sql import functions as F

from adherence.operators import dims as D
from adherence.operators import runs as RUNS
from adherence.operators.synth import synthetic_facts
from adherence.sources import warehouse as W


def test_energy_partitions_replaced_even_when_empty(spark, tmp_path):
    out = str(tmp_path / "energy")
    day1 = spark.createDataFrame([(20260712, "all", 1, 50.0), (20260712, "inner_stockholm", 1, 40.0)],
                                 "date_key int, region_id string, route_key long, energy_score double")
    W.write_energy(day1, out)
    rerun = spark.createDataFrame([(20260712, "all", 2, 60.0)], day1.schema)
    W.write_energy(rerun, out, requested=[(20260712, "all"), (20260712, "inner_stockholm")])
    got = {(r.region_id, r.route_key) for r in spark.read.parquet(out).collect()}
    assert got == {("all", 2)}


def test_facts_reload_replaces_only_its_dates(spark, tmp_path):
    out = str(tmp_path / "facts")
    f = synthetic_facts(spark, "2026-07-10", days=3)
    W.write_facts(f, out)
    W.write_facts(f.filter("date_key = 20260711").limit(5), out)
    back = spark.read.parquet(out)
    assert back.filter("date_key = 20260711").count() == 5
    assert back.filter("date_key = 20260710").count() == 40 * 6
    assert W.read_star(spark, out, 20260712, 20260712).count() == 40 * 6


def test_synthetic_facts_shape(spark):
    f = synthetic_facts(spark, "2026-07-10", days=2)
    r = f.agg(F.count(F.lit(1)).alias("n"), F.min("delay_seconds").alias("lo"), F.max("delay_seconds").alias("hi")).first()
    assert r.n == 2 * 40 * 6 and r.lo >= -600 and r.hi <= 3600


def test_wide_csv_round_trip(spark, tmp_path):
    rows = [(20260712, "2026-07-12", "Sun", 7, "T1", 1, "2026-07-12 08:00:00", "garbage", 60, "gtfs_rt", "R1", "1",
             "Line", "S1", "Alpha", 59.3, 18.0, "Bus", None)]
    df = spark.createDataFrame(rows, W.WIDE_SCHEMA)
    W.export_wide(df, str(tmp_path / "wide"))
    back = W.read_wide_csv(spark, str(tmp_path / "wide")).first()
    assert back.actual_arrival is None and back.hour_of_day == 8 and back.full_date == dt.date(2026, 7, 12)
    assert W.export_energy(spark.createDataFrame([], W.ENERGY_WIDE_SCHEMA), str(tmp_path / "e")) is False
    try:
        W.export_wide(df.limit(0), str(tmp_path / "w2"))
        raise AssertionError("empty export must be refused")
    except W.EmptyExportError:
        pass


def test_runs_latest(spark, tmp_path):
    t = dt.datetime
    a = RUNS.run_record(spark, "2026-07-12", "success", 10, "run-a", t(2026, 7, 12, 1), t(2026, 7, 12, 2))
    b = RUNS.run_record(spark, "2026-07-12", "success", 12, "run-b", t(2026, 7, 12, 3), t(2026, 7, 12, 4))
    c = RUNS.run_record(spark, "2026-07-12", "running", 0, "run-c", t(2026, 7, 12, 5), None)
    c = c.withColumn("finished_at", F.lit(None).cast("timestamp"))
    ev = RUNS.dq_event(spark, "2026-07-12", "warn", "run-b")
    path = str(tmp_path / "runs")
    for df in (a, b, c, ev):
        RUNS.append(df, path)
    latest = RUNS.latest(spark.read.parquet(path)).collect()
    assert len(latest) == 1 and latest[0].dag_run_id == "run-b" and latest[0].dq_status == "warn"


def test_dim_merge_stable_keys(spark):
    v1 = spark.createDataFrame([("R1", "1"), ("R2", "2")], "route_id string, route_short_name string")
    m1 = D.merge_scd1(None, v1, ["route_id"], "SL", "route_key")
    v2 = spark.createDataFrame([("R2", "2X"), ("R3", "3")], "route_id string, route_short_name string")
    m2 = D.merge_scd1(m1, v2, ["route_id"], "SL", "route_key")
    got = {r.route_id: (r.route_short_name, r.route_key) for r in m2.collect()}
    k1 = {r.route_id: r.route_key for r in m1.collect()}
    assert got["R1"] == ("1", k1["R1"]) and got["R2"] == ("2X", k1["R2"]) and "R3" in got


def test_calendar_span(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2027, 12, 31),)], "full_date date")
    cal = D.calendar_from_dates(d)
    assert cal.count() == 1461
    r = cal.filter("date_key = 20240101").first()
    assert (r.day_of_week, r.day_name, r.is_weekend) == (1, "Mon", False)


def test_fact_build_rejects_and_quarantine(spark):
    from adherence.operators import facts as FACTS
    t = dt.datetime(2026, 7, 12, 8, 0)
    derived = spark.createDataFrame([
        ("T1", "S1", "1", "R1", "3", dt.date(2026, 7, 12), t, t, 60, 1),
        ("T1", "S2", "2", "R1", "3", dt.date(2026, 7, 12), None, None, 30, 2),        # malformed time (D12)
        ("T2", "S1", "1", "R1", "3", dt.date(2026, 7, 12), t, t, 20000, 3),           # out of range
        ("T3", "S9", "1", "R1", "3", dt.date(2026, 7, 12), t, t, 5, 4),               # stop not in dim
    ], "trip_id string, stop_id string, stop_sequence string, route_id string, route_type string, "
       "service_date date, scheduled_arrival timestamp_ntz, actual_arrival timestamp_ntz, delay_seconds int, "
       "actual_epoch long")
    routes = D.merge_scd1(None, spark.createDataFrame([("R1",)], "route_id string"), ["route_id"], "SL", "route_key")
    stops = D.merge_scd1(None, spark.createDataFrame([("S1",), ("S2",)], "stop_id string"), ["stop_id"], "SL", "stop_key")
    facts, report, rejects = FACTS.build(derived, routes, stops, D.vehicle_type_dim(spark))
    assert sorted(r.trip_id for r in facts.collect()) == ["T1", "T2"]
    assert [(r.trip_id, r.reject_reason) for r in rejects.collect()] == [("T1", "null_scheduled_arrival")]
    assert report.first().skipped_no_dim == 1
    facts_q, _, rejects_q = FACTS.build(derived, routes, stops, D.vehicle_type_dim(spark), quarantine_out_of_range=True)
    assert [r.trip_id for r in facts_q.collect()] == ["T1"]
    assert sorted(r.reject_reason for r in rejects_q.collect()) == ["delay_out_of_range", "null_scheduled_arrival"]


def test_star_vs_wide_parity(spark, sf_dir, tmp_path):
    """S14 export -> gz CSV -> S12 read -> the same delay answers as the star."""
    import __spark_entry__ as E
    from adherence.operators import delays as A
    from adherence.sources import driver

    wide = E.queries()["wide_export"](spark, sf_dir)
    W.export_wide(wide.select([c if c not in ("full_date", "scheduled_arrival", "actual_arrival")
                               else F.col(c).cast("string").alias(c) for c in wide.columns]), str(tmp_path / "w"))
    back = W.star_from_wide(W.read_wide_csv(spark, str(tmp_path / "w")))
    star = driver.star(spark, sf_dir)

    def rows(df):
        return sorted((tuple(r) for r in df.drop("rank").collect()),
                      key=lambda t: tuple((x is None, str(x)) for x in t))

    assert rows(A.kpis(star)) == rows(A.kpis(back))
    assert rows(A.route_lateness(star, min_observations=1, limit=1000)) == \
        rows(A.route_lateness(back, min_observations=1, limit=1000))
    assert rows(A.delay_heatmap(star)) == rows(A.delay_heatmap(back))
    assert rows(A.worst_stops(star, limit=1000, min_observations=1)) == \
        rows(A.worst_stops(back, limit=1000, min_observations=1))
