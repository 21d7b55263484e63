"""Delay derivation (F5-F8) as Column expressions.

Sign contract: > 0 late, 0 on time, < 0 early, NULL unknown (never coerced to 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def delay_seconds(rt_delay, actual_epoch, scheduled_epoch) -> Column:
    """the realtime delay if present, else actual - scheduled, else NULL."""
    diff = F.try_subtract(_c(actual_epoch).cast("bigint"), _c(scheduled_epoch).cast("bigint"))
    return F.coalesce(_c(rt_delay).cast("bigint"), diff).try_cast("int")  # an absurd epoch -> NULL, not a failure


def actual_epoch(rt_actual_epoch, scheduled_epoch, rt_delay) -> Column:
    """the realtime time if present, else scheduled + delay, else NULL."""
    return F.coalesce(_c(rt_actual_epoch), F.try_add(_c(scheduled_epoch).cast("bigint"), _c(rt_delay).cast("bigint")))


def choose_event(arrival, departure, field: str) -> Column:
    """take ``field`` of the arrival event when the arrival message is present, else of the
    departure (a present-but-empty arrival hides the departure, as in the source feed)."""
    a, d = _c(arrival), _c(departure)
    return F.when(a.isNotNull(), a.getField(field)).otherwise(d.getField(field))


def blank_to_null(x) -> Column:
    """F8: empty string -> NULL."""
    return F.nullif(_c(x), F.lit(""))
