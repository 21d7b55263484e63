"""Golden values for GTFS time parsing (F1-F4, F9) plus DST cases the source lacks."""
import datetime as dt

from pyspark.sql import functions as F

from adherence.functions import gtfs_time as T


def one(spark, expr, schema="x string", row=("",)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first().v


def test_post_midnight_seconds_and_datetime(spark):
    assert one(spark, T.gtfs_time_to_seconds(F.lit("25:30:00"))) == 91800
    assert one(spark, T.gtfs_time_to_datetime(F.lit("2026-07-11"), F.lit("25:30:00"))) == dt.datetime(2026, 7, 12, 1, 30)


def test_normal_time_and_blanks(spark):
    assert one(spark, T.gtfs_time_to_seconds(F.lit("08:15:30"))) == 29730
    assert one(spark, T.gtfs_time_to_seconds(F.lit("  08:15:30 "))) == 29730


def test_malformed_time_is_null(spark):
    for bad in ["8:15", "", "ab:cd:ef", "1:2:3:4"]:
        assert one(spark, T.gtfs_time_to_seconds(F.lit(bad))) is None


def test_date_key(spark):
    assert one(spark, T.date_key(F.lit("2026-07-11").cast("date"))) == 20260711


def test_rt_start_epoch_zone_aware_and_session_independent(spark):
    e = T.rt_start_to_epoch(F.lit("20260712"), F.lit("15:54:00"))
    expected = int(dt.datetime(2026, 7, 12, 13, 54, tzinfo=dt.timezone.utc).timestamp())
    assert one(spark, e) == expected
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, e) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_rt_start_missing_part_and_bare_epoch(spark):
    assert one(spark, T.rt_start_to_epoch(F.lit("20260712"), F.lit(None).cast("string"))) is None
    assert one(spark, T.rt_start_to_epoch(F.lit(None).cast("string"), F.lit("10:00:00"))) is None
    assert one(spark, T.rt_start_to_epoch(F.lit("20260712"), F.lit("1783864440"))) == 1783864440


def test_dst_gap_and_overlap_first_occurrence(spark):
    assert one(spark, T.rt_start_to_epoch(F.lit("20260329"), F.lit("02:30:00"))) == 1774747800
    assert one(spark, T.rt_start_to_epoch(F.lit("20261025"), F.lit("02:30:00"))) == 1792888200


def test_calendar_attributes(spark):
    d = F.lit("2026-07-12").cast("date")  # a Sunday
    assert one(spark, T.iso_day_of_week(d)) == 7
    assert one(spark, T.day_name(d)) == "Sun"
    assert one(spark, T.is_weekend(d)) is True
    assert one(spark, T.iso_day_of_week(F.lit("2026-07-13").cast("date"))) == 1


def test_coordinate_parse(spark):
    assert one(spark, T.parse_coordinate(F.lit(""))) is None
    assert one(spark, T.parse_coordinate(F.lit("59.33"))) == 59.33
    assert one(spark, T.parse_coordinate(F.lit("north"))) is None


def test_absurd_values_become_null_not_failures(spark):
    from adherence.functions import delay as DL
    assert one(spark, T.gtfs_time_to_seconds(F.lit("999999999:00:00"))) is None
    assert one(spark, T.gtfs_time_to_seconds(F.lit("99999999999999999999:00:00"))) is None
    df = spark.createDataFrame([(None, 9_000_000_000_000_000_000, -9_000_000_000_000_000_000)], "d int, a long, s long")
    assert df.select(DL.delay_seconds("d", "a", "s").alias("v")).first().v is None
