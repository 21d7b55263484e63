"""GTFS / GTFS-RT time handling as native Column expressions (no Python UDF).

Conventions
-----------
* A GTFS time ``HH:MM:SS`` is seconds after midnight of the service date and may pass 24:00.
* Local wall time is carried as ``TIMESTAMP_NTZ`` (so ``hour()`` means local hour under any
  session zone); instants are carried as UTC epoch seconds computed with an explicit zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adherence.constants import DEFAULT_ZONE

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def gtfs_time_to_seconds(t) -> Column:
    """``'25:30:00' -> 91800``; blanks around allowed; anything malformed -> NULL."""
    parts = F.split(F.trim(_c(t)), ":")
    h = F.get(parts, 0).try_cast("bigint")
    m = F.get(parts, 1).try_cast("bigint")
    s = F.get(parts, 2).try_cast("bigint")
    # try_ arithmetic: one absurd value (e.g. 999999999:00:00) becomes NULL instead of failing the job
    total = F.try_add(F.try_add(F.try_multiply(h, F.lit(3600)), F.try_multiply(m, F.lit(60))), s)
    return F.when(F.size(parts) == 3, total.try_cast("int"))


def service_day_start(service_date) -> Column:
    """Midnight of the service date as local wall time."""
    return _c(service_date).try_cast("date").cast("timestamp_ntz")


def local_datetime(service_date, seconds) -> Column:
    """service date + seconds after midnight -> local NTZ datetime (day overflow included)."""
    return F.timestamp_add("SECOND", _c(seconds), service_day_start(service_date))


def gtfs_time_to_datetime(service_date, t) -> Column:
    """F1 + F2 on a GTFS time string."""
    return local_datetime(service_date, gtfs_time_to_seconds(t))


def date_key(d) -> Column:
    """date -> yyyymmdd integer."""
    d = F.to_date(_c(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def local_to_epoch(local_ntz, zone: str = DEFAULT_ZONE) -> Column:
    """Local wall time in ``zone`` -> UTC epoch seconds, independent of the session zone.

    A wall time inside a DST gap or overlap resolves to the earlier offset (first occurrence).
    """
    utc_ntz = F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(local_ntz))
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), utc_ntz)


def epoch_to_local(epoch, zone: str = DEFAULT_ZONE) -> Column:
    """UTC epoch seconds -> local NTZ wall time in ``zone``."""
    utc_ntz = F.timestamp_add("SECOND", _c(epoch), F.expr(_EPOCH_NTZ))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz)


def rt_start_to_epoch(start_date, start_time, zone: str = DEFAULT_ZONE) -> Column:
    """GTFS-RT (start_date yyyymmdd, start_time HH:MM:SS local) -> epoch; a bare number is
    already an epoch; either part missing/blank -> NULL."""
    sd = F.nullif(F.trim(_c(start_date)), F.lit(""))
    st = F.nullif(F.trim(_c(start_time)), F.lit(""))
    day = F.try_to_date(sd, "yyyyMMdd")
    local = local_datetime(day, gtfs_time_to_seconds(st))
    return (
        F.when(sd.isNull() | st.isNull(), F.lit(None).cast("bigint"))
        .when(F.instr(st, ":") == 0, st.try_cast("bigint"))
        .otherwise(local_to_epoch(local, zone))
    )


def iso_day_of_week(d) -> Column:
    """ISO weekday, Monday = 1 ... Sunday = 7."""
    return ((F.dayofweek(_c(d)) + 5) % 7 + 1).cast("int")


def day_name(d) -> Column:
    """abbreviated English day name ``Mon`` ... ``Sun``."""
    return F.date_format(_c(d), "E")


def is_weekend(d) -> Column:
    return iso_day_of_week(d).isin(6, 7)


def hour_of(ts) -> Column:
    """hour of a local NTZ timestamp."""
    return F.hour(_c(ts)).cast("int")


def parse_coordinate(x) -> Column:
    """blank -> NULL, else double (malformed -> NULL)."""
    return F.nullif(F.trim(_c(x)), F.lit("")).try_cast("double")
