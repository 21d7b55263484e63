"""Geometry helpers (E1, P8) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adherence.constants import EARTH_RADIUS_KM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; the asin argument is clamped to 1."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def in_bbox(lat, lon, bbox) -> Column:
    """Inclusive bounding-box test; ``bbox`` None means everywhere."""
    if bbox is None:
        return F.lit(True)
    min_lat, max_lat, min_lon, max_lon = bbox
    return _c(lat).between(min_lat, max_lat) & _c(lon).between(min_lon, max_lon)
