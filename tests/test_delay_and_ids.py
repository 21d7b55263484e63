"""Golden values for delay derivation (F5/F6) and stop-id translation."""
import pytest

from adherence.constants import REALTIME_FEED_REGIONAL, STATIC_FEED_NATIONAL
from adherence.functions import delay as DL
from adherence.functions.ids import rt_stop_id

S = 1_000_000  # scheduled epoch (08:00 stand-in)


@pytest.mark.parametrize("rt_delay,actual,expected", [
    (None, S + 330, 330),      # late 08:05:30
    (None, S - 120, -120),     # early 07:58
    (None, S, 0),              # on time
    (None, None, None),        # no realtime -> NULL, never 0
    (90, S + 600, 90),         # realtime delay preferred
    (-45, None, -45),          # delay alone
    (0, None, 0),              # an explicit zero delay is a measurement
])
def test_delay_seconds(spark, rt_delay, actual, expected):
    df = spark.createDataFrame([(rt_delay, actual, S)], "d int, a long, s long")
    assert df.select(DL.delay_seconds("d", "a", "s").alias("v")).first().v == expected


def test_actual_epoch_fallback(spark):
    df = spark.createDataFrame([(None, S, 90), (S + 5, S, 90), (None, S, None)], "a long, s long, d int")
    got = [r.v for r in df.select(DL.actual_epoch("a", "s", "d").alias("v")).collect()]
    assert got == [S + 90, S + 5, None]


def test_stop_id_translation(spark):
    df = spark.createDataFrame([("9022001000101001",), ("9011001000101001",), ("",)], "s string")
    mixed = [r.v for r in df.select(rt_stop_id("s", STATIC_FEED_NATIONAL, REALTIME_FEED_REGIONAL).alias("v")).collect()]
    assert mixed == ["9011001000101001", "9011001000101001", None]
    same = [r.v for r in df.select(rt_stop_id("s", REALTIME_FEED_REGIONAL, REALTIME_FEED_REGIONAL).alias("v")).collect()]
    assert same == ["9022001000101001", "9011001000101001", None]
