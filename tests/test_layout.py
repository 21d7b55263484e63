"""Tables by trip: the join, the first stop and the de-duplication without an exchange, and equal results."""
import uuid

import pytest
from pyspark.sql import functions as F

from adherence.operators import facts as FACTS
from adherence.operators import match as M
from adherence.sources import driver
from adherence.sources import layout as LAY


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    base, tag = tmp_path_factory.mktemp("layout"), uuid.uuid4().hex[:8]
    st, trips = driver.stop_times_txt(spark, sf_dir), driver.trips_txt(spark, sf_dir)
    out = (LAY.store_by_trip(st, f"st_{tag}", str(base / "st"), 8, ("stop_sequence",)), LAY.store_by_trip(trips, f"trips_{tag}", str(base / "trips"), 8))
    yield st, trips, *out, base, tag
    for t in ("st", "trips"):
        spark.sql(f"DROP TABLE IF EXISTS {t}_{tag}")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    return old


def test_join_and_first_stop_move_no_rows(spark, stored):
    st, trips, st_b, trips_b, _, _ = stored
    gtfs = lambda t, s: M.Gtfs(None, trips.select("route_id").distinct(), t, st.select("stop_id").distinct(), s)
    old = no_broadcast(spark)
    try:
        joined = M.operator_stop_times(gtfs(trips_b, st_b), "x")
        assert exchanges(joined) == 0
        starts = M.trip_starts(joined)
        assert exchanges(starts) == 0
        plain = M.trip_starts(M.operator_stop_times(gtfs(trips, st), "x"))
        assert exchanges(plain) > 0
        assert starts.count() == plain.count() and starts.exceptAll(plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dedupe_moves_no_rows(spark, sf_dir, tmp_path):
    raw = driver.facts(spark, sf_dir, dedupe=False).withColumn("actual_epoch", F.lit(None).cast("long"))
    name = f"raw_{uuid.uuid4().hex[:8]}"
    by_trip = LAY.store_by_trip(raw, name, str(tmp_path / "raw"), 8)
    try:
        got, want = FACTS.dedupe(by_trip), FACTS.dedupe(raw)
        assert exchanges(got) == 0 and exchanges(want) > 0
        assert got.count() == want.count() < raw.count() + 1 and got.exceptAll(want).isEmpty()
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_attached_in_another_catalog(spark, stored):
    _, _, _, trips_b, base, tag = stored
    schema = ", ".join(f"{n} {t}" for n, t in trips_b.dtypes)
    again = LAY.attach(spark, f"again_{tag}", str(base / "trips"), schema, 8)
    try:
        assert exchanges(again.groupBy("trip_id").count()) == 0 and again.count() == trips_b.count()
    finally:
        spark.sql(f"DROP TABLE again_{tag}")
