"""End to end on a written mini feed: 5 stops, 3 routes, 10 trips, two realtime snapshots.

Covers S1-S7, P1-P3, J1-J9, W1, W3, F4-F8, L3-L5, L10 and the D-list cases: zero delay, arrival
present but empty, loop trip with a repeated stop, duplicate update, blank stop id, post-midnight
time, band edges 300/301 s, NULL start, unknown route_type, idempotent reload."""
import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from adherence.constants import STATIC_FEED_NATIONAL, REALTIME_FEED_REGIONAL
from adherence.operators import dims as D
from adherence.operators import facts as FACTS
from adherence.operators import match as M
from adherence.sources import gtfs_static as G
from adherence.sources import landing as L
from adherence.sources import tripupdates as TU
from adherence.sources import warehouse as W

SERVICE_DATE = "2026-07-12"

AGENCY = "agency_id,agency_name\n505000000000000001,AB Storstockholms Lokaltrafik\n999,Other Co\n"
ROUTES = ("route_id,agency_id,route_short_name,route_long_name,route_type\n"
          "R1,505000000000000001,1,Line one,3\nR2,505000000000000001,2,Line two,401\nR3,999,3,Line three,\n")
STOPS = ("stop_id,stop_name,stop_lat,stop_lon\nS1,Alpha,59.33,18.06\nS2,Beta,59.34,18.06\nS3,Gamma,59.35,18.07\n"
         "S4,Delta,,\nS5,Epsilon,59.31,18.00\n")


def _trips_and_times():
    trips = ["route_id,service_id,trip_id"]
    times = ["trip_id,arrival_time,departure_time,stop_id,stop_sequence"]
    for i in range(1, 11):
        route = "R1" if i <= 5 else ("R2" if i <= 9 else "R3")
        trips.append(f"{route},WK,T{i}")
        start = 8 * 3600 + (i - 1) * 1800 if route == "R1" else 23 * 3600 + (i - 6) * 1200
        stops = ["S1", "S2", "S3", "S1"] if i == 1 else ["S1", "S2", "S3"]
        for seq, s in enumerate(stops, start=1):
            t = start + (seq - 1) * 300
            hms = f"{t // 3600:02d}:{t % 3600 // 60:02d}:{t % 60:02d}"
            times.append(f"T{i},{hms},{hms},{s},{seq}")
    return "\n".join(trips) + "\n", "\n".join(times) + "\n"


def _feed(entities):
    C = TU.message_classes()
    fm = C["FeedMessage"]()
    fm.header.gtfs_realtime_version = "2.0"
    for n, (trip, route, start, updates) in enumerate(entities):
        e = fm.entity.add()
        e.id = str(n)
        tu = e.trip_update
        tu.trip.trip_id = trip
        tu.trip.route_id = route
        tu.trip.start_date = "20260712"
        if start:
            tu.trip.start_time = start
        for stop, seq, arr, dep in updates:
            u = tu.stop_time_update.add()
            u.stop_id = stop
            if seq is not None:
                u.stop_sequence = seq
            if arr is not None:
                u.arrival.SetInParent()
                for k, v in arr.items():
                    setattr(u.arrival, k, v)
            if dep is not None:
                u.departure.SetInParent()
                for k, v in dep.items():
                    setattr(u.departure, k, v)
    return fm.SerializeToString()


PRIMARY = [
    ("T1", "R1", "08:00:00", [("S1", 1, {"delay": 60}, None), ("S2", 2, {"delay": 0}, None),
                              ("S3", 3, {}, {"delay": 30}), ("S1", 4, {"delay": 120}, None), ("", 5, {"delay": 9}, None)]),
    ("T2", "R1", "08:30:00", [("S1", 1, {"delay": 10}, None)]),
    ("T2", "R1", "08:30:00", [("S1", 1, {"delay": 20}, None)]),          # duplicate update entity
    ("T6", "R2", "23:00:00", [("S3", 3, None, {"time": 0, "delay": -45})]),
]
FALLBACK = [
    ("X1", "R1", "08:05:00", [("S2", 2, {"delay": 40}, None)]),          # 300 s from T1 -> match
    ("X2", "R1", "08:35:01", [("S2", 2, {"delay": 50}, None)]),          # 301 s from T2 -> none
    ("X3", "R1", None, [("S3", 3, {"delay": 70}, None)]),               # NULL start -> all R1 trips
]


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    base = tmp_path_factory.mktemp("landing")
    trips, times = _trips_and_times()
    zdir = base / "static" / SERVICE_DATE
    zdir.mkdir(parents=True)
    with zipfile.ZipFile(zdir / "gtfs.zip", "w") as z:
        for name, text in [("agency.txt", AGENCY), ("routes.txt", ROUTES), ("trips.txt", trips),
                           ("stops.txt", STOPS), ("stop_times.txt", times)]:
            z.writestr(name, text)
    for snap, ents in [("06-00-00", PRIMARY[:1]), ("06-15-00", PRIMARY)]:
        d = base / "realtime" / SERVICE_DATE / snap
        d.mkdir(parents=True)
        (d / "tripupdates.pb").write_bytes(_feed(ents))
    fb = base / "fallback" / "realtime" / SERVICE_DATE / "07-00-00"
    fb.mkdir(parents=True)
    (fb / "tripupdates.pb").write_bytes(_feed(FALLBACK))
    return base


@pytest.fixture(scope="module")
def feed(spark, landing):
    archives = L.list_files(spark, str(landing), "static", "gtfs.zip")
    members = G.list_members(archives)
    L.check_members(members)
    staged = G.stage_members(members, str(landing / "staged"))
    assert staged.count() == 5
    return G.read_feed(spark, str(landing / "staged"))


def test_layout_and_latest_snapshot(spark, landing):
    snaps = L.list_files(spark, str(landing), "realtime", "tripupdates.pb")
    assert snaps.count() == 2
    latest = L.latest_snapshots(snaps).collect()
    assert len(latest) == 1 and latest[0].snapshot_ts == dt.datetime(2026, 7, 12, 6, 15)
    assert L.latest_snapshot_path(spark, str(landing), SERVICE_DATE).endswith("06-15-00/tripupdates.pb")
    with pytest.raises(L.MissingInputError):
        L.latest_snapshot_path(spark, str(landing), "2025-01-01")


def test_missing_member_is_reported(spark):
    m = spark.createDataFrame([("x.zip", "stops.txt"), ("x.zip", "routes.txt")], "path string, member string")
    assert sorted(r.member for r in L.missing_members(m).collect()) == ["stop_times.txt", "trips.txt"]
    with pytest.raises(L.MissingInputError):
        L.check_members(m)


def test_decode_presence_semantics(spark, landing):
    path = L.latest_snapshot_path(spark, str(landing), SERVICE_DATE)
    rows = TU.decode(spark.read.format("binaryFile").load(path)).collect()
    assert len(rows) == 7  # blank stop id dropped
    by = {(r.trip_id, r.stop_id, r.stop_sequence): r for r in rows}
    assert by[("T1", "S2", 2)].delay_seconds == 0                       # zero is a measurement (D1 fixed)
    assert by[("T1", "S3", 3)].delay_seconds is None                    # empty arrival hides departure (D2)
    assert by[("T6", "S3", 3)].delay_seconds == -45 and by[("T6", "S3", 3)].actual_epoch == 0
    assert by[("T1", "S1", 1)].snapshot_ts == dt.datetime(2026, 7, 12, 6, 15)
    parity = TU.decode(spark.read.format("binaryFile").load(path), zero_is_missing=True).collect()
    assert {(r.trip_id, r.stop_id, r.stop_sequence): r for r in parity}[("T1", "S2", 2)].delay_seconds is None
    counts = TU.entity_counts(spark.read.format("binaryFile").load(path)).first()
    assert counts.entity_count == 4


def test_operator_filter_and_trip_start(spark, feed):
    st = M.operator_stop_times(feed, STATIC_FEED_NATIONAL)
    assert st.select("trip_id").distinct().count() == 9                 # R3 belongs to another agency
    sched = M.scheduled(feed, STATIC_FEED_NATIONAL, service_date=SERVICE_DATE)
    t9 = sched.filter("trip_id = 'T9' and stop_sequence = '3'").first()
    assert t9.scheduled_arrival == dt.datetime(2026, 7, 13, 0, 10)       # 24:10:00 post midnight
    t1 = sched.filter("trip_id = 'T1'").select("trip_start_epoch").distinct().collect()
    assert [r.trip_start_epoch for r in t1] == [int(dt.datetime(2026, 7, 12, 6, 0, tzinfo=dt.timezone.utc).timestamp())]


def _rt(spark, landing, sub=""):
    base = landing / sub if sub else landing
    files = TU.read_snapshots(spark, str(base / "realtime"))
    files = files.join(L.latest_snapshots(files.select("path", "service_date", "snapshot_ts")), "path", "left_semi")
    return M.prepare_realtime(TU.decode(files), STATIC_FEED_NATIONAL, REALTIME_FEED_REGIONAL)


def test_primary_match_dedupe_and_load(spark, feed, landing, tmp_path):
    sched = M.scheduled(feed, STATIC_FEED_NATIONAL, service_date=SERVICE_DATE)
    matched, strategy = M.match(sched, _rt(spark, landing))
    assert strategy == "primary"
    derived = M.derive(matched)
    routes = D.merge_scd1(None, feed.routes.select("route_id", "route_short_name", "route_long_name"),
                          ["route_id"], "SL", "route_key")
    stops = D.merge_scd1(None, M.referenced_stops(feed.stops, feed.stop_times), ["stop_id"], "SL", "stop_key")
    vt = D.vehicle_type_dim(spark)
    facts, report, rejects = FACTS.build(derived, routes, stops, vt)
    assert rejects.count() == 0
    rep = report.first()
    assert rep.rows_seen == derived.count()
    assert rep.duplicates_collapsed == rep.rows_seen - rep.rows_loaded - rep.skipped_no_dim
    got = {(r.trip_id, r.stop_sequence): r.delay_seconds for r in facts.collect()}
    assert got[("T1", 1)] == 60 and got[("T1", 4)] == 120               # loop trip: equal sequence wins (D7)
    assert got[("T1", 2)] == 0 and got[("T1", 3)] is None
    assert got[("T2", 1)] in (10, 20) and len([k for k in got if k[0] == "T2"]) == 1
    assert got[("T6", 3)] == -45
    vkeys = {r.trip_id: r.vehicle_type_key for r in facts.select("trip_id", "vehicle_type_key").distinct().collect()}
    assert vkeys["T1"] == D.bus_key() and vkeys["T6"] == D.bus_key()     # route_type 401 unknown -> Bus
    out = str(tmp_path / "facts")
    W.write_facts(facts, out)
    W.write_facts(facts, out)                                             # reload: idempotent
    assert spark.read.parquet(out).count() == facts.count()


def test_fallback_band_and_null_start(spark, feed, landing):
    sched = M.scheduled(feed, STATIC_FEED_NATIONAL, service_date=SERVICE_DATE)
    matched, strategy = M.match(sched, _rt(spark, landing, "fallback"))
    assert strategy == "fallback"
    got = sorted((r.trip_id, r.stop_sequence, r.delay_seconds) for r in matched.collect())
    assert ("T1", "2", 40) in got                                         # exactly 300 s apart
    assert not [g for g in got if g[2] == 50]                             # 301 s apart
    assert sorted(g[0] for g in got if g[2] == 70) == ["T1", "T2", "T3", "T4", "T5"]
    brute = sched.alias("s").join(_rt(spark, landing, "fallback").alias("r"),
                                  ["route_id", "stop_id", "stop_sequence"]).filter(
        F.col("r.trip_start_epoch").isNull() | F.col("s.trip_start_epoch").isNull()
        | (F.abs(F.col("r.trip_start_epoch") - F.col("s.trip_start_epoch")) <= 300))
    assert brute.count() == len(got)


def test_no_match_raises(spark, feed):
    sched = M.scheduled(feed, STATIC_FEED_NATIONAL, service_date=SERVICE_DATE)
    rt = spark.createDataFrame([("Z", "RX", None, "20260712", "S9", "1", 5, None)],
                               "trip_id string, route_id string, trip_start_epoch long, start_date string, "
                               "stop_id string, stop_sequence string, delay_seconds int, actual_epoch long")
    with pytest.raises(M.NoMatchError):
        M.match(sched, rt)


def test_sidecars_audit_inventory(spark, landing, tmp_path):
    side = spark.createDataFrame([("SL", "static", "2026-07-11T06:00:00+00:00", 10, 200, "sl", SERVICE_DATE),
                                  ("SL", "static", "not a time", 10, 200, "sl", "2026-07-13")],
                                 L.METADATA_SCHEMA)
    p = str(tmp_path / "meta")
    L.write_sidecars(side, p)
    (tmp_path / "meta" / "broken.json").write_text("{not json\n")
    back = L.read_sidecars(spark, p)
    assert back.filter(F.col("pulled_at").isNotNull()).count() == 1
    ages = {str(r.service_date): r.age_days for r in
            L.static_age_days(back, dt.datetime(2026, 7, 12, 6, 0)).collect() if r.service_date}
    assert ages[SERVICE_DATE] == pytest.approx(1.0) and ages["2026-07-13"] is None
    audit = str(tmp_path / "audit")
    L.append_audit(spark.createDataFrame([("2026-07-12T06:15:00Z", "realtime", SERVICE_DATE, "x", 10)],
                                         "timestamp_utc string, feed_type string, service_date string, file_path string, bytes long"), audit)
    L.append_audit(spark.createDataFrame([("2026-07-12T06:30:00Z", "realtime", SERVICE_DATE, "y", 12)],
                                         "timestamp_utc string, feed_type string, service_date string, file_path string, bytes long"), audit)
    inv = L.inventory(spark, str(landing), audit=L.read_audit(spark, audit)).collect()
    assert len(inv) == 1
    r = inv[0]
    assert r.n_snapshots == 2 and r.audit_lines == 2 and r.static_bytes > 0
    assert r.latest_snapshot == dt.datetime(2026, 7, 12, 6, 15)
    os.listdir(audit)


def test_options_keep_unmatched_and_service_day(spark, feed, landing):
    sched = M.scheduled(feed, STATIC_FEED_NATIONAL, service_date=SERVICE_DATE)
    rt = _rt(spark, landing)
    inner = M.match_primary(sched, rt).count()
    left = M.match_primary(sched, rt, keep_unmatched=True)
    assert left.count() > inner and left.filter("delay_seconds is null and actual_epoch is null").count() > 0
    other_day = rt.withColumn("start_date", F.lit("20260713"))
    assert M.same_service_day(other_day, SERVICE_DATE).count() == 0
    assert M.same_service_day(rt, SERVICE_DATE).count() == rt.count()


def test_calendar_active_services(spark):
    cal = spark.createDataFrame([("WK", "1", "1", "1", "1", "1", "0", "0", "20260101", "20261231"),
                                 ("WE", "0", "0", "0", "0", "0", "1", "1", "20260101", "20261231")],
                                ",".join(f"{c} string" for c in G.GTFS_COLUMNS["calendar"]))
    cdates = spark.createDataFrame([("XTRA", "20260712", "1"), ("WE", "20260712", "2")],
                                   "service_id string, date string, exception_type string")
    got = sorted(r.service_id for r in M.active_services(cal, cdates, "2026-07-12").collect())  # a Sunday
    assert got == ["XTRA"]
    got = sorted(r.service_id for r in M.active_services(cal, cdates, "2026-07-13").collect())
    assert got == ["WK"]


def test_jobs_end_to_end(spark, landing, tmp_path):
    from adherence.plans import jobs
    wh = str(tmp_path / "warehouse")
    rep = jobs.run_transform(spark, SERVICE_DATE, str(landing), wh, "SL")
    assert rep["strategy"] == "primary" and rep["rows_loaded"] > 0
    n1 = spark.read.parquet(f"{wh}/fact_trip_delay").count()
    jobs.run_transform(spark, SERVICE_DATE, str(landing), wh, "SL")          # rerun: same date replaced
    assert spark.read.parquet(f"{wh}/fact_trip_delay").count() == n1 == rep["rows_loaded"]
    assert W.read_dim(spark, f"{wh}/dim_route").count() == 2  # the operator's own
    rep_dq = {r.check_id: r.passed for r in jobs.run_quality(spark, SERVICE_DATE, wh).collect()}
    assert rep_dq["DQ-001"] and rep_dq["DQ-005"] and rep_dq["DQ-006"] and not rep_dq["DQ-007"]
    with pytest.raises(Exception, match="DQ-001"):
        jobs.run_quality(spark, "2025-01-01", wh)                             # empty date fails the gate
    assert jobs.run_energy(spark, SERVICE_DATE, wh) >= 0
    from adherence.operators import delays as A
    star = W.load_star(spark, wh, 20260712, 20260712)
    k = A.kpis(star).first()
    assert k.total_facts == n1 and k.trips_observed == 3
    plan = A.kpis(star)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan                  # static partition pruning
    runs = spark.read.parquet(f"{wh}/pipeline_runs")
    assert runs.filter("status = 'success'").count() == 2


def test_stream_snapshots_keep_latest(spark, landing, tmp_path):
    """R1 + R2 on real snapshots: a binaryFile stream, one file per trigger, merged keep-latest;
    equals the batch keep-latest over the same files."""
    from adherence.streaming import snapshots as S
    root = str(landing / "realtime")
    stream = S.stream_trip_updates(spark, root, max_files=1)
    q = S.run_latest_merge(stream, S.UPDATE_KEYS, S.UPDATE_ORDER, S.UPDATE_VALUES, str(tmp_path / "latest"),
                           str(tmp_path / "ck"), "service_date")
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "latest"))
    batch = S.latest_per_key(TU.decode(TU.read_snapshots(spark, root)), S.UPDATE_KEYS, S.UPDATE_ORDER, S.UPDATE_VALUES)
    cols = S.UPDATE_KEYS + ["snapshot_ts", "delay_seconds"]
    assert got.count() == batch.count() > 0
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0


def test_first_stop_beyond_any_hour(spark):
    """The first stop is the one with the lowest sequence, however late it departs."""
    df = spark.createDataFrame([("T", "1", "300:00:00", dt.date(2026, 7, 12)), ("T", "2", "05:00:00", dt.date(2026, 7, 12))],
                               "trip_id string, stop_sequence string, departure_time string, service_date date")
    assert M.trip_starts(df).first().trip_start_ts == dt.datetime(2026, 7, 24, 12)


def test_same_ids_of_two_operators_do_not_fan_out(spark):
    from adherence.operators import dims as D
    from adherence.operators import facts as FACTS
    routes = spark.createDataFrame([("R", "a", 1), ("R", "b", 2)], "route_id string, operator string, route_key long")
    stops = spark.createDataFrame([("S", "a", 3), ("S", "b", 4)], "stop_id string, operator string, stop_key long")
    row = spark.createDataFrame([("T", "S", "1", "R", "3", dt.date(2026, 7, 12), dt.datetime(2026, 7, 12, 8), None, None, 60),
                                 (None, "S", "1", "R", "3", dt.date(2026, 7, 12), dt.datetime(2026, 7, 12, 8), None, None, 60)],
                                "trip_id string, stop_id string, stop_sequence string, route_id string, route_type string, service_date date, "
                                "scheduled_arrival timestamp_ntz, actual_arrival timestamp_ntz, actual_epoch long, delay_seconds int")
    facts, report, rejects = FACTS.build(row, routes, stops, D.vehicle_type_dim(spark), operator="b")
    got = facts.collect()
    assert [(r.route_key, r.stop_key) for r in got] == [(2, 4)]
    rep = report.first()
    assert rep.rows_loaded == 1 and rep.rows_rejected == 1 and rep.rows_seen == 2 and rejects.count() == 1


def test_a_reload_without_rows_leaves_none(spark, tmp_path):
    from adherence.sources import warehouse as W
    df = spark.createDataFrame([(20260712, 1, "T", 1), (20260713, 1, "T", 1)], "date_key int, route_key long, trip_id string, stop_sequence int")
    path = str(tmp_path / "rejects")
    W.write_facts(df, path)
    W.write_facts(df.limit(0), path, requested=20260712)
    assert [r.date_key for r in spark.read.parquet(path).select("date_key").collect()] == [20260713]


def test_dimension_versions(spark, tmp_path):
    from adherence.sources import warehouse as W
    path = str(tmp_path / "dim")
    assert W.read_dim(spark, path) is None
    for n in (1, 2, 3):
        assert W.replace_dim(spark.range(n), path).count() == n
    (tmp_path / "dim" / "v=000000009").mkdir()  # a version that was never completed
    assert W.read_dim(spark, path).count() == 3
    assert sorted(p.name for p in (tmp_path / "dim").iterdir()) == ["v=000000002", "v=000000003", "v=000000009"]


def test_leftover_staging_files_are_not_data(spark, tmp_path):
    (tmp_path / "stops" / "_tmp").mkdir(parents=True)
    (tmp_path / "stops" / "a.txt").write_text("stop_id,stop_name,stop_lat,stop_lon\nS1,One,59.1,18.1\n")
    (tmp_path / "stops" / "_tmp" / "0123").write_text("stop_id,stop_name,stop_lat,stop_lon\nS1,One,59.1,18.1\nS2,Tr")
    assert G.read_table(spark, str(tmp_path / "stops"), "stops").count() == 1


def test_status_of_another_run_does_not_leak(spark):
    from adherence.operators import runs as RUNS
    a = RUNS.run_record(spark, "2026-07-12", "success", 1, "A", finished_at=dt.datetime(2026, 7, 12, 1))
    b = RUNS.run_record(spark, "2026-07-12", "success", 1, "B", finished_at=dt.datetime(2026, 7, 12, 2))
    ev = RUNS.dq_event(spark, "2026-07-12", "passed", "A")
    assert RUNS.latest(a.unionByName(b).unionByName(ev)).first().dq_status is None
    assert RUNS.latest(a.unionByName(b).unionByName(RUNS.dq_event(spark, "2026-07-12", "warn"))).first().dq_status == "warn"


def test_cli_entry_points(spark, landing, tmp_path):
    from adherence.plans import jobs
    wh = str(tmp_path / "wh")
    base = ["--service-date", SERVICE_DATE, "--raw-base-path", str(landing), "--warehouse", wh]
    assert jobs.main(["transform", *base, "--operator-name", "SL"]) == 0
    assert jobs.main(["quality", "--service-date", SERVICE_DATE, "--warehouse", wh]) == 0
    assert jobs.main(["energy", "--service-date", SERVICE_DATE, "--warehouse", wh]) == 0
    assert spark.read.parquet(f"{wh}/fact_trip_delay").count() > 0


def test_a_load_changes_all_its_tables_or_none(spark, landing, tmp_path, monkeypatch):
    """Facts, rejects, roll-up and scores of a date switch together; killed before, none does."""
    from adherence.operators import delays as A
    from adherence.operators import rollup as U
    from adherence.plans import jobs
    from adherence.sources import versions as V

    wh = str(tmp_path / "warehouse")
    first = jobs.run_transform(spark, SERVICE_DATE, str(landing), wh, "SL", with_energy=True)
    tables = ["fact_trip_delay", "fact_rejects", "fact_route_energy_score", W.HISTOGRAM_TABLE, W.TRIPS_TABLE]
    assert V.names(spark, wh) == sorted(tables)

    def content():
        return {t: sorted(map(str, V.read(spark, wh, t).collect())) for t in tables}

    before = content()
    assert len(before["fact_trip_delay"]) == first["rows_loaded"] and before["fact_route_energy_score"]
    write = V.Load.write
    for dies_at in tables[1:]:
        def killed(self, df, table, *args, dies_at=dies_at):
            if table == dies_at:
                raise RuntimeError(f"killed at {dies_at}")
            return write(self, df.limit(1), table, *args)  # the new load is another one

        monkeypatch.setattr(V.Load, "write", killed)
        with pytest.raises(RuntimeError, match="killed"):
            jobs.run_transform(spark, SERVICE_DATE, str(landing), wh, "SL", with_energy=True)
        assert content() == before
    monkeypatch.setattr(V.Load, "write", lambda self, df, table, *args: write(self, df.limit(1), table, *args))
    jobs.run_transform(spark, SERVICE_DATE, str(landing), wh, "SL", with_energy=True, retain=1)
    after = content()
    assert len(after["fact_trip_delay"]) == 1 and after["fact_route_energy_score"] != before["fact_route_energy_score"]
    monkeypatch.setattr(V.Load, "write", write)
    jobs.run_transform(spark, SERVICE_DATE, str(landing), wh, "SL", with_energy=True)
    assert content() == before

    star, rollup = W.load_star(spark, wh, 20260712, 20260712), W.load_rollup(spark, wh, 20260712, 20260712)
    same = lambda a, b: sorted(map(tuple, a.select(*b.columns).collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert same(A.kpis(star), U.kpis(rollup)) and same(A.punctuality_summary(star), U.punctuality_summary(rollup))
    assert same(A.route_lateness(star, min_observations=1), U.route_lateness(rollup, min_observations=1))
    assert same(A.delay_heatmap(star), U.delay_heatmap(rollup)) and same(A.stops_map(star), U.stops_map(rollup))
    empty = W.load_rollup(spark, wh, 20250101, 20250102)
    assert same(A.kpis(W.load_star(spark, wh, 20250101, 20250102)), U.kpis(empty))


def test_histograms_of_dates_merge(spark, sf_dir):
    from adherence.operators import rollup as U
    from adherence.sources import driver
    facts = driver.facts(spark, sf_dir)
    whole = U.delay_histogram(facts)
    parts = U.merge_histograms(*[U.delay_histogram(facts.where(F.col("stop_sequence") % 3 == i)) for i in range(3)])
    assert parts.select(*whole.columns).exceptAll(whole).isEmpty() and whole.exceptAll(parts.select(*whole.columns)).isEmpty()


def _fallback_sides(spark, null_schedule, null_realtime, hot):
    """A hot key that holds a third of both sides, and starts around bucket borders."""
    import random
    rng = random.Random(7)
    start = lambda p: None if rng.random() < p else rng.randrange(0, 2400, 25)
    key = lambda i: ("R", "S", "1") if i % 3 == 0 and hot else (f"R{i % 5}", f"S{i % 4}", str(i % 3))
    day = dt.date(2026, 7, 12)
    s = [(day, *key(i), f"T{i}", start(null_schedule)) for i in range(240)]
    r = [(f"X{i}", *key(i), start(null_realtime), "20260712" if i % 7 else None, i, None) for i in range(300)]
    return (spark.createDataFrame(s, "service_date date, route_id string, stop_id string, stop_sequence string, trip_id string, trip_start_epoch long"),
            spark.createDataFrame(r, "trip_id string, route_id string, stop_id string, stop_sequence string, trip_start_epoch long, start_date string, delay_seconds int, actual_epoch long"))


@pytest.mark.parametrize("nulls", [(0, 0), (0.3, 0), (0, 0.3), (0.3, 0.3)])
@pytest.mark.parametrize("hot_rows", [9, 100_000])
def test_fallback_parts_equal_brute_force(spark, nulls, hot_rows):
    """J8 with each NULL case, hot keys dealt over a grid or not: every pair once."""
    s, r = _fallback_sides(spark, *nulls, hot=True)
    got = M.match_fallback(s, r, default_date="2026-07-12", hot_rows=hot_rows)
    day = F.coalesce(F.to_date("start_date", "yyyyMMdd"), F.lit("2026-07-12").cast("date"))
    q = r.select(day.alias("service_date"), "route_id", "stop_id", "stop_sequence", F.col("trip_start_epoch").alias("rt"), "delay_seconds")
    want = s.join(q, ["service_date", "route_id", "stop_id", "stop_sequence"]).where(
        "rt is null or trip_start_epoch is null or abs(rt - trip_start_epoch) <= 300")
    rows = lambda d: sorted((x.trip_id, x.delay_seconds) for x in d.select("trip_id", "delay_seconds").collect())
    assert rows(got) == rows(want) and got.count() > 500
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 + sum(n > 0 for n in nulls)          # no part without such rows
    if hot_rows == 100_000:
        assert plan.count("Generate explode") == 1                            # the probes of the band, and no copies


def test_spread_join_bounds_what_a_task_gets(spark):
    """A key with a third of the rows on both sides ends in cells of about ``hot_rows`` a side."""
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(600).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("b"))
    out = M.spread_join(left, right, ["k"], hot_rows=50)
    assert out.count() == left.join(right, "k").count() == out.distinct().count()
    assert out.where("k = 0").count() == 300 * 200
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_strip" in plan and "_lane" in plan
    small = M.spread_join(left, right, ["k"], hot_rows=500)._jdf.queryExecution().optimizedPlan().toString()
    assert "_strip" not in small


def test_snapshot_source_plans_folders_and_sets_dead_snapshots_aside(spark, landing, tmp_path):
    """Equal to the file reader; filters reach the folder listing; a broken snapshot fails nothing."""
    import shutil
    root = tmp_path / "realtime"
    shutil.copytree(landing / "realtime", root)
    other = root / "2026-07-13" / "06-00-00"
    other.mkdir(parents=True)
    (other / "tripupdates.pb").write_bytes(_feed(PRIMARY[:2]))
    for name, content in (("06-30-00", b"\xff not a feed"), ("06-45-00", None)):
        (root / SERVICE_DATE / name).mkdir()
        if content is not None:
            (root / SERVICE_DATE / name / "tripupdates.pb").write_bytes(content)
    (root / SERVICE_DATE / "notes").mkdir()
    snaps = TU.load(spark, str(root))
    columns = ["service_date", "snapshot_ts", "trip_id", "route_id", "start_date", "stop_id", "stop_sequence", "delay_seconds", "actual_epoch", "trip_start_epoch"]
    flat = TU.updates(snaps).select(*columns)
    want = TU.decode(TU.read_snapshots(spark, [str(landing / "realtime"), str(root / "2026-07-13")])).select(*columns)
    assert flat.count() == want.count() > 0 and flat.exceptAll(want).isEmpty()
    dead = {str(r.snapshot_ts): r.error for r in TU.dead_letters(snaps).collect()}
    assert sorted(dead) == ["2026-07-12 06:30:00", "2026-07-12 06:45:00"]
    assert "DecodeError" in dead["2026-07-12 06:30:00"] and "FileNotFound" in dead["2026-07-12 06:45:00"]
    parts = lambda d: d.rdd.getNumPartitions()
    assert parts(snaps) == 5
    assert parts(TU.load(spark, str(root)).where("service_date = DATE'2026-07-13'")) == 1
    assert parts(TU.load(spark, str(root)).where("snapshot_ts < TIMESTAMP_NTZ'2026-07-12 06:30:00'")) == 2
    assert parts(TU.load(spark, str(root), **{"from": "2026-07-13"})) == 1
    assert [str(r[0]) for r in TU.load(spark, str(root), latest="true").select("snapshot_ts").distinct().orderBy("snapshot_ts").collect()] == [
        "2026-07-12 06:45:00", "2026-07-13 06:00:00"]
    assert TU.load(spark, str(tmp_path / "none")).count() == 0


def test_feed_stream_deltas_and_dead_letters(spark, landing, tmp_path):
    """R1 + R2 from the landing folder: what lands between runs is picked up, dead snapshots beside it."""
    import shutil

    from adherence.sources import versions as V
    from adherence.streaming import snapshots as S
    src, root, wh, ck = landing / "realtime" / SERVICE_DATE, tmp_path / "realtime", str(tmp_path / "wh"), str(tmp_path / "ck")
    run = lambda: S.run_feed_deltas(spark, str(root), wh, "latest", ck).awaitTermination(300)
    shutil.copytree(src / "06-00-00", root / SERVICE_DATE / "06-00-00")
    run()
    (root / SERVICE_DATE / "06-05-00").mkdir()
    (root / SERVICE_DATE / "06-05-00" / "tripupdates.pb").write_bytes(b"\xff\xff")
    shutil.copytree(src / "06-15-00", root / SERVICE_DATE / "06-15-00")
    run()
    run()  # nothing new
    got = S.read_latest(spark, wh, "latest", S.UPDATE_KEYS, S.UPDATE_ORDER, S.UPDATE_VALUES)
    want = S.latest_per_key(TU.decode(TU.read_snapshots(spark, str(landing / "realtime"))), S.UPDATE_KEYS, S.UPDATE_ORDER, S.UPDATE_VALUES)
    columns = [c for c in want.columns if c != "path"]
    assert got.count() == want.count() > 0 and got.select(*columns).exceptAll(want.select(*columns)).isEmpty()
    assert [str(r.snapshot_ts) for r in V.read(spark, wh, "latest_dead").collect()] == ["2026-07-12 06:05:00"]


def test_transform_sets_dead_snapshots_aside(spark, landing, tmp_path):
    import shutil

    from adherence.plans import jobs
    base, wh = tmp_path / "landing", str(tmp_path / "wh")
    shutil.copytree(landing / "static", base / "static")
    shutil.copytree(landing / "realtime", base / "realtime")
    broken = base / "realtime" / SERVICE_DATE / "06-20-00"
    broken.mkdir()
    (broken / "tripupdates.pb").write_bytes(b"\xff\xff")
    rep = jobs.run_transform(spark, SERVICE_DATE, str(base), wh, "SL", mode="all")
    assert rep["rows_loaded"] > 0 and spark.read.parquet(f"{wh}/dead_letters").count() == 1
    with pytest.raises(ValueError, match="no TripUpdates"):
        jobs.run_transform(spark, SERVICE_DATE, str(base), wh, "SL")  # the latest one is dead


def test_columns_are_bound_by_each_files_header(spark, tmp_path):
    """Two archives with other column orders, an extra column, a byte-order mark and a missing column."""
    folder = tmp_path / "stops"
    folder.mkdir()
    (folder / "a.txt").write_text("stop_id,stop_name,stop_lat,stop_lon\nS1,\"One, two\",59.1,18.1\n", encoding="utf-8-sig")
    (folder / "b.txt").write_text("zone,stop_lon,stop_lat,stop_name,stop_id\r\nZ,18.2,59.2,Two,S2\r\n")
    (folder / "c.txt").write_text("stop_id,stop_name,stop_id\nS3,Three,other\n")
    (folder / "d.txt").write_text("")
    rows = sorted(tuple(r) for r in G.read_table(spark, str(folder), "stops").collect())
    assert rows == [("S1", "One, two", "59.1", "18.1"), ("S2", "Two", "59.2", "18.2"), ("S3", "Three", None, None)]
    (tmp_path / "trips").mkdir()
    (tmp_path / "trips" / "a.txt").write_text("")
    assert G.read_table(spark, str(tmp_path / "trips"), "trips").count() == 0


def test_members_that_an_archive_no_longer_has_are_gone(spark, landing, tmp_path):
    """A re-pulled archive without its calendar is read without one."""
    import shutil

    from adherence.plans import jobs
    base, wh = tmp_path / "landing", str(tmp_path / "wh")
    shutil.copytree(landing / "static", base / "static")
    shutil.copytree(landing / "realtime", base / "realtime")
    archive = base / "static" / SERVICE_DATE / "gtfs.zip"
    plain = archive.read_bytes()
    with zipfile.ZipFile(archive, "a") as z:
        z.writestr("calendar_dates.txt", "service_id,date,exception_type\nother,20260712,1\n")
    with pytest.raises(M.NoMatchError):  # no trip runs by that calendar
        jobs.run_transform(spark, SERVICE_DATE, str(base), wh, "SL", use_calendar=True)
    archive.write_bytes(plain)
    assert jobs.run_transform(spark, SERVICE_DATE, str(base), wh, "SL", use_calendar=True)["rows_loaded"] > 0


def test_sample_is_exact_for_every_limit(spark, sf_dir):
    from adherence.operators import delays as A
    from adherence.operators.filters import Filters
    from adherence.sources import driver
    st = driver.star(spark, sf_dir)
    some = Filters(start_date="1997-01-01", end_date="1997-01-31")
    n = A.delay_view(st, some, measured=True).count()
    for limit in (1, 2, 7, n - 1, n, n + 5):
        assert A.delay_sample(st, some, limit).count() == min(limit, n)
    assert A.delay_sample(st, Filters(start_date="1900-01-01", end_date="1900-01-02"), 3).count() == 0
