"""Identifier normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adherence.constants import (
    OPERATOR_AGENCY_IDS_NATIONAL,
    OPERATOR_AGENCY_IDS_REGIONAL,
    OPERATOR_NAME_CONTAINS,
    OPERATOR_NAME_EXACT,
    REALTIME_FEED_REGIONAL,
    RT_STOP_PREFIX_FROM,
    RT_STOP_PREFIX_TO,
    STATIC_FEED_NATIONAL,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rt_stop_id(stop_id, static_feed: str, realtime_feed: str) -> Column:
    """Blank -> NULL; for a national static feed matched with a regional realtime feed the
    realtime prefix 9022 becomes 9011; otherwise unchanged."""
    s = F.nullif(_c(stop_id), F.lit(""))
    if static_feed == STATIC_FEED_NATIONAL and realtime_feed == REALTIME_FEED_REGIONAL:
        n = len(RT_STOP_PREFIX_FROM)
        return F.when(
            s.startswith(RT_STOP_PREFIX_FROM),
            F.concat(F.lit(RT_STOP_PREFIX_TO), F.substring(s, n + 1, 1 << 30)),
        ).otherwise(s)
    return s


def operator_agency_predicate(static_feed: str) -> Column:
    """Agencies of the operator in a multi-operator feed; a per-operator feed keeps all."""
    if static_feed == REALTIME_FEED_REGIONAL:
        return F.lit(True)
    ids = OPERATOR_AGENCY_IDS_NATIONAL + OPERATOR_AGENCY_IDS_REGIONAL
    name = F.lower(F.col("agency_name"))
    return (
        F.col("agency_id").isin(ids)
        | (name == OPERATOR_NAME_EXACT)
        | name.contains(OPERATOR_NAME_CONTAINS)
    )


def as_key_string(x) -> Column:
    """Keys compared as strings on both sides of a match."""
    return _c(x).cast("string")


def stable_key(*parts) -> Column:
    """Stable, distributed surrogate key (no global counter)."""
    return F.xxhash64(*[_c(p).cast("string") for p in parts])


def uniform(*parts: Column) -> Column:
    """Uniform in [0, 1) from a digest of the parts: the same on every engine, run and partitioning."""
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(1 << 52))
