"""Data-quality checks (Q1-Q9) on hand-written stats, and the gate."""
import pytest

from adherence.operators import quality as Q

STATS = "date_key int, row_count long, null_trip_ids long, out_of_range long, null_delays long"


def report(spark, stats, dups=0, orphans=0, age=None):
    from pyspark.sql import functions as F
    s = spark.createDataFrame([stats], STATS)
    d = spark.createDataFrame([(stats[0], dups)], "date_key int, dup_count long")
    o = spark.createDataFrame([(stats[0], orphans)], "date_key int, orphan_rows long")
    rep = Q.report(s, d, o, static_age_days=F.lit(age).cast("double"))
    return {r.check_id: r.passed for r in rep.collect()}, rep


def test_all_pass(spark):
    got, rep = report(spark, (1, 638, 0, 0, 10), age=1.0)
    assert all(got.values())
    assert Q.status(rep).first().dq_status == "passed"
    Q.gate(rep)


def test_failures_in_order(spark):
    got, rep = report(spark, (1, 100, 3, 5, 90), dups=2, orphans=1, age=10.0)
    assert got == {"DQ-001": True, "DQ-002": False, "DQ-003": False, "DQ-004": False,
                   "DQ-005": False, "DQ-006": False, "DQ-007": False}
    assert Q.status(rep).first().dq_status == "failed"
    with pytest.raises(Q.DataQualityError):
        Q.gate(rep)


def test_empty_date_fails_and_unknown_age_fails(spark):
    got, rep = report(spark, (1, 0, 0, 0, 0), age=None)
    assert got["DQ-001"] is False and got["DQ-004"] is True and got["DQ-007"] is False
    with pytest.raises(Q.DataQualityError):
        Q.gate(rep)


def test_warn_only_does_not_raise(spark):
    got, rep = report(spark, (1, 100, 0, 5, 10), age=1.0)
    assert got["DQ-003"] is False
    assert Q.status(rep).first().dq_status == "warn"
    Q.gate(rep)


def test_rejects_split(spark):
    import datetime as dt
    df = spark.createDataFrame([
        ("a", dt.datetime(2026, 1, 1), 100), (None, dt.datetime(2026, 1, 1), 0), ("b", dt.datetime(2026, 1, 1), 20000),
        ("c", dt.datetime(2026, 1, 1), None)], "trip_id string, scheduled_arrival timestamp_ntz, delay_seconds int")
    ok, bad = Q.split_rejects(df)
    assert ok.count() == 2
    assert sorted(r.reject_reason for r in bad.collect()) == ["delay_out_of_range", "null_trip_id"]


def test_profile_equals_the_checks_one_by_one(spark):
    """One pass against the frames of each check, with nulls, duplicates, several dates and odd keys."""
    import random

    from pyspark.sql import functions as F
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3]), rng.choice([None, "a", "b", "c"]), rng.choice([1, 2, 9, None]), rng.choice([1, 2]), rng.choice([5, 6, None]),
             rng.choice([None, 0, 50_000, -9_000]), rng.randint(1, 4)) for _ in range(500)]
    facts = spark.createDataFrame(rows, "date_key int, trip_id string, stop_key long, stop_sequence int, route_key long, delay_seconds int, n_rows long")
    dims = {"stop": (spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "stop_key long, n string"), "stop_key"),
            "route": (spark.createDataFrame([(5,)], "route_key long"), "route_key")}
    got = Q.profile(facts, dims)
    want = Q.fact_stats(facts).join(Q.duplicate_grain(facts), "date_key").join(Q.orphan_rows_by_date(facts, dims), "date_key")
    assert got.count() == 3 and sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    copies = Q.profile(facts, dims, copies="n_rows").agg(F.sum("dup_count")).first()[0]
    assert copies == sum(r[6] for r in rows) - len({r[:4] for r in rows})
    assert Q.profile(facts.where("false"), dims).count() == 0


@pytest.mark.parametrize("name", ["dq_report", "dq_status"])
def test_checks_read_the_facts_once(spark, sf_dir, name):
    from adherence.plans import catalog
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber#") and plan.count("l_returnflag#") and plan.count("Relation [l_orderkey") == 1


def test_referential_counts_keys_not_combinations(spark):
    """null and repeated keys, a dimension with repeated rows, two dimensions on one key; facts aren't shuffled by combinations."""
    facts = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (None, 12), (3, None), (3, 10)], "a int, b int")
    one = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    two = spark.createDataFrame([(10,), (None,)], "b int")
    other = spark.createDataFrame([(3,)], "a int")
    rep = Q.referential(facts, {"one": (one, "a"), "two": (two, "b"), "other": (other, "a")})
    assert {(r.dimension, r.orphan_rows) for r in rep.collect()} == {("one", 3), ("two", 3), ("other", 4)}
    assert "BroadcastHashJoin" in rep._jdf.queryExecution().executedPlan().toString() and "Expand" in rep._jdf.queryExecution().executedPlan().toString()
    empty = Q.referential(facts.where("false"), {"one": (one, "a")})
    assert [tuple(r) for r in empty.collect()] == [("one", 0)]


def test_partitions_follow_rows(spark, monkeypatch):
    """as many partitions as keep one at so many rows, whatever Spark would coalesce to."""
    from adherence import session as S
    monkeypatch.setattr(S, "TASK_ROWS", 10)
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert S.by_rows(df, 1000, "k").rdd.getNumPartitions() == 100
    assert S.by_rows(df, 10, "k").rdd.getNumPartitions() <= 8


def test_lookups_in_a_large_dimension_follow_rows(spark, sf_dir, monkeypatch):
    """facts that meet a dimension beyond a broadcast are dealt by their number, not by Spark's partitions."""
    from adherence import session as S
    from adherence.operators import dims as D
    from adherence.plans import catalog
    want = catalog.QUERIES["key_lookup_report"](spark, sf_dir).collect()
    monkeypatch.setattr(D, "DIM_ROWS", 5)
    monkeypatch.setattr(S, "TASK_ROWS", 200)
    n = -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // 200)
    got = catalog.QUERIES["key_lookup_report"](spark, sf_dir)
    import re
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"RepartitionByExpression \[stop_key#\d+L?\], {n}\b", plan)
    assert got.collect() == want
