"""Stream vs batch parity for R1-R3 (file-source stream, availableNow trigger)."""
import pytest
from pyspark.sql import functions as F

from adherence.sources import driver
from adherence.streaming import snapshots as S


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    """The events table split into three landed files, as three 15-minute pulls would be."""
    base = tmp_path_factory.mktemp("stream")
    e = driver.read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    e = e.withColumn("k", F.get_json_object("props", "$.k").try_cast("int")).drop("props")
    for i in range(3):
        e.filter(F.col("event_id") % 3 == i).coalesce(1).write.mode("overwrite").parquet(str(base / "in" / f"part{i}"))
    return base, e


def test_window_stats_complete_mode_equals_batch(spark, landed):
    base, e = landed
    stream = S.stream_files(spark, str(base / "in" / "*"), e.schema, max_files=1)
    q = S.run_window_stats(stream, "ts", ["event_type"], "value", "1000 days", str(base / "win"), str(base / "ck_win"),
                           mode="complete")
    q.awaitTermination(300)
    streamed = spark.read.parquet(str(base / "win"))
    batch = S.window_stats(e, "ts", ["event_type"], "value")
    cols = ["window_start", "window_end", "event_type", "n"]
    assert streamed.count() == batch.count()
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0


def test_window_stats_append_mode_closed_windows(spark, landed, tmp_path):
    """Time-ordered pulls: every window the watermark has closed equals batch; open ones wait."""
    _, e = landed
    src = tmp_path / "ordered"
    bounds = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    cut = bounds.lo + (bounds.hi - bounds.lo) / 2
    e.filter(F.col("ts") < cut).coalesce(1).write.parquet(str(src / "a"))
    e.filter(F.col("ts") >= cut).coalesce(1).write.parquet(str(src / "b"))
    stream = S.stream_files(spark, str(src / "*"), e.schema, max_files=1)
    q = S.run_window_stats(stream, "ts", ["event_type"], "value", "30 minutes", str(tmp_path / "win"),
                           str(tmp_path / "ck"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(str(tmp_path / "win"))
    batch = S.window_stats(e, "ts", ["event_type"], "value")
    cols = ["window_start", "window_end", "event_type", "n"]
    assert streamed.count() > 0
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert streamed.agg(F.max("window_end")).first()[0] <= bounds.hi


def test_latest_merge_stream_equals_batch(spark, landed):
    base, e = landed
    stream = S.stream_files(spark, str(base / "in" / "*"), e.schema, max_files=1)
    stream = stream.withColumn("service_date", F.to_date("ts"))
    keyed = ["service_date", "user_id", "k"]
    q = S.run_latest_merge(stream, keyed, ["ts", "event_id"], ["value"], str(base / "latest"), str(base / "ck_latest"),
                           "service_date")
    q.awaitTermination(300)
    streamed = spark.read.parquet(str(base / "latest")).select(*keyed, "value", "ts", "event_id")
    batch = S.latest_per_key(e.withColumn("service_date", F.to_date("ts")), keyed, ["ts", "event_id"], ["value"])
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_latest_snapshot_rows(spark, landed):
    _, e = landed
    rows = S.latest_snapshot_rows(e)
    per_day = rows.groupBy("service_date").agg(F.countDistinct("snapshot_ts").alias("n")).collect()
    assert per_day and all(r.n == 1 for r in per_day)
