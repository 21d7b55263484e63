"""Versions of tables: one switch, killed loads, deltas and folds; and the streams that rest on them."""
import pytest
from pyspark.sql import functions as F

from adherence.sources import driver
from adherence.sources import versions as V
from adherence.streaming import snapshots as S

SCHEMA = "day int, k string, v long"


def rows(df):
    return sorted(tuple(r) for r in df.select("day", "k", "v").collect())


def test_tables_of_a_load_change_together(spark, tmp_path):
    root = str(tmp_path)
    assert V.read(spark, root, "a") is None
    first = V.Load(spark, root)
    for t in "ab":
        first.write(spark.createDataFrame([(1, t, 1), (2, t, 2)], SCHEMA), t, ["day"])
    assert V.read(spark, root, "a") is None and rows(first.staged("a")) == [(1, "a", 1), (2, "a", 2)]
    assert first.publish() == 1
    killed = V.Load(spark, root)  # ends before its second table
    killed.write(spark.createDataFrame([(1, "a", 10)], SCHEMA), "a", ["day"])
    assert rows(V.read(spark, root, "a")) == [(1, "a", 1), (2, "a", 2)]
    again = V.Load(spark, root)
    again.write(spark.createDataFrame([(1, "a", 100)], SCHEMA), "a", ["day"])
    again.write(spark.createDataFrame([], SCHEMA), "b", ["day"], requested=["day=1"])
    again.publish(retain=1)
    assert rows(V.read(spark, root, "a")) == [(1, "a", 100), (2, "a", 2)]
    assert rows(V.read(spark, root, "b")) == [(2, "b", 2)]
    assert rows(V.read(spark, root, "b", back=1)) == [(1, "b", 1), (2, "b", 2)]  # what a reader holds stays
    assert rows(V.read(spark, root, "a", V.between("day", 2, 2))) == [(2, "a", 2)]
    assert V.sweep(spark, root) == 0 and V.sweep(spark, root, older_than_hours=-1) == 2  # the killed load's folder, and one without rows
    assert rows(V.read(spark, root, "a")) == [(1, "a", 100), (2, "a", 2)]


def test_superseded_files_go_and_schemas_may_grow(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        load = V.Load(spark, root)
        load.write(spark.createDataFrame([(1, "x", n)], SCHEMA), "a", ["day"])
        load.publish()
    assert spark.read.parquet(f"{root}/a").count() == 1
    load = V.Load(spark, root)
    load.write(spark.createDataFrame([(2, "y", 5, 7)], SCHEMA + ", w long"), "a", ["day"])
    load.publish()
    assert sorted((r.day, r.v, r.w) for r in V.read(spark, root, "a").collect()) == [(1, 2, None), (2, 5, 7)]


def test_jobs_that_publish_at_once_both_count(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    one, two = V.Load(spark, root), V.Load(spark, root)
    one.write(spark.createDataFrame([(1, "x", 1)], SCHEMA), "a", ["day"])
    two.write(spark.createDataFrame([(2, "x", 2)], SCHEMA), "a", ["day"])
    put = V._put

    def beaten(*args):
        monkeypatch.setattr(V, "_put", put)
        two.publish()  # comes in between
        return put(*args)

    monkeypatch.setattr(V, "_put", beaten)
    one.publish()
    assert rows(V.read(spark, root, "a")) == [(1, "x", 1), (2, "x", 2)]


def test_a_fold_keeps_what_came_meanwhile(spark, tmp_path):
    root = str(tmp_path)

    def add(n):
        load = V.Load(spark, root, ("q", n))
        assert not load.published()
        load.write(spark.createDataFrame([(1, "x", n)], SCHEMA), "a", ["day"])
        load.publish(add=True)

    add(0)
    add(1)
    entry = V.pointer(spark, root)["tables"]["a"]
    fold = V.Load(spark, root)
    fold.write(V.read_parts(spark, root, "a", entry, entry["parts"]).groupBy("day", "k").agg(F.sum("v").alias("v")), "a", ["day"])
    add(2)
    fold.publish(folded={"a": entry["parts"]})
    assert rows(V.read(spark, root, "a")) == [(1, "x", 1), (1, "x", 2)]
    assert V.Load(spark, root, ("q", 1)).published() and not V.Load(spark, root, ("q", 3)).published()


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    e = driver.read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    e = e.withColumn("k", F.get_json_object("props", "$.k").try_cast("int")).drop("props").withColumn("service_date", F.to_date("ts"))
    for i in range(4):
        e.filter(F.col("event_id") % 4 == i).drop("service_date").coalesce(1).write.parquet(str(base / f"part{i}"))
    return base, e


KEYS, ORDER, VALUES = ["service_date", "user_id", "k"], ["ts", "event_id"], ["value"]


def _stream(spark, landed, files="*"):
    base, e = landed
    return S.stream_files(spark, str(base / files), e.drop("service_date").schema, max_files=1).withColumn("service_date", F.to_date("ts"))


def test_deltas_equal_batch_before_and_after_compaction(spark, landed, tmp_path):
    root, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    S.run_latest_deltas(_stream(spark, landed), KEYS, ORDER, VALUES, root, "latest", ck, "service_date").awaitTermination(300)
    want = S.latest_per_key(landed[1], KEYS, ORDER, VALUES)
    columns = want.columns

    def same():
        got = S.read_latest(spark, root, "latest", KEYS, ORDER, VALUES)
        return got.count() == want.count() and got.select(*columns).exceptAll(want).count() == 0

    assert same() and V.pointer(spark, root)["version"] == 4
    before = {p for p in (tmp_path / "wh" / "latest").rglob("*.parquet")}
    assert S.compact_latest(spark, root, "latest", KEYS, ORDER, VALUES) > 0
    assert same() and before <= {p for p in (tmp_path / "wh" / "latest").rglob("*.parquet")}  # readers of the old version go on
    assert all(len(loads) == 1 for loads in V.pointer(spark, root)["tables"]["latest"]["parts"].values())
    assert S.compact_latest(spark, root, "latest", KEYS, ORDER, VALUES) == 0


def test_a_batch_killed_half_way_loses_nothing(spark, landed, tmp_path, monkeypatch):
    root, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    publish, calls = V.Load.publish, []

    def dies_once(self, **options):
        calls.append(self.id)
        if len(calls) == 3:
            raise RuntimeError("killed after its files were written")
        return publish(self, **options)

    monkeypatch.setattr(V.Load, "publish", dies_once)
    with pytest.raises(Exception, match="killed"):
        S.run_latest_deltas(_stream(spark, landed), KEYS, ORDER, VALUES, root, "latest", ck, "service_date").awaitTermination(300)
    assert V.pointer(spark, root)["version"] == 2
    S.compact_latest(spark, root, "latest", KEYS, ORDER, VALUES)
    S.run_latest_deltas(_stream(spark, landed), KEYS, ORDER, VALUES, root, "latest", ck, "service_date").awaitTermination(300)
    want = S.latest_per_key(landed[1], KEYS, ORDER, VALUES)
    got = S.read_latest(spark, root, "latest", KEYS, ORDER, VALUES)
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0


def test_copy_on_write_never_touches_live_files(spark, landed, tmp_path, monkeypatch):
    """Killed between writing and the switch: the table is the one before, and a rerun ends right."""
    root = tmp_path / "wh"
    publish, calls = V.Load.publish, []

    def dies_once(self, **options):
        calls.append(self.id)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return publish(self, **options)

    monkeypatch.setattr(V.Load, "publish", dies_once)
    with pytest.raises(Exception, match="killed"):
        S.run_latest_merge(_stream(spark, landed), KEYS, ORDER, VALUES, str(root / "latest"), str(tmp_path / "ck"), "service_date").awaitTermination(300)
    first = V.read(spark, str(root), "latest").count()
    assert first > 0
    S.run_latest_merge(_stream(spark, landed), KEYS, ORDER, VALUES, str(root / "latest"), str(tmp_path / "ck"), "service_date").awaitTermination(300)
    want = S.latest_per_key(landed[1], KEYS, ORDER, VALUES)
    got = V.read(spark, str(root), "latest")
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0


def _windows(df):
    return {(r.window_start, r.event_type): (r.n, round(r.avg_value, 9)) for r in df.collect()}


def test_late_files_end_in_the_totals_of_a_batch(spark, landed, tmp_path, monkeypatch):
    """Newest half first, so the other half is far older than the watermark; one batch dies on the way."""
    _, e = landed
    src, root, ck = tmp_path / "src", str(tmp_path / "wh"), str(tmp_path / "ck")
    cut = e.agg(F.percentile_approx(F.col("ts").cast("timestamp"), 0.5)).first()[0]
    e.filter(F.col("ts") >= cut).coalesce(1).write.parquet(str(src / "a"))
    run = lambda: S.run_window_sums(S.stream_files(spark, str(src / "*"), e.schema, max_files=1), "ts", ["event_type"], "value",
                                    "30 minutes", root, "windows", ck).awaitTermination(300)
    run()
    assert S.read_windows(spark, root, "windows", ["event_type"], late_only=True).count() == 0
    e.filter(F.col("ts") < cut).coalesce(1).write.parquet(str(src / "b"))
    publish, calls = V.Load.publish, []

    def dies_once(self, **options):
        calls.append(self.id)
        if len(calls) == 1:
            publish(self, **options)
            raise RuntimeError("killed after the switch")  # the batch is repeated and must not count twice
        return publish(self, **options)

    monkeypatch.setattr(V.Load, "publish", dies_once)
    with pytest.raises(Exception, match="killed"):
        run()
    S.compact_windows(spark, root, "windows", ["event_type"])
    run()
    want = _windows(S.window_stats(e, "ts", ["event_type"], "value"))
    assert _windows(S.read_windows(spark, root, "windows", ["event_type"])) == want
    late = S.read_windows(spark, root, "windows", ["event_type"], late_only=True)
    assert 0 < late.agg(F.sum("n")).first()[0] <= e.filter(F.col("ts") < cut).count()
    S.compact_windows(spark, root, "windows", ["event_type"])
    assert _windows(S.read_windows(spark, root, "windows", ["event_type"])) == want
