"""Fixed values that must equal the reference's for identical results.

They are stated here once, plainly and in their natural order.
"""

from __future__ import annotations

# --- fixed values: GTFS route_type seed of the vehicle-type dimension (key = position) ---
VEHICLE_TYPES: list[tuple[int, str]] = [
    (0, "Tram"),
    (1, "Metro"),
    (2, "Rail"),
    (3, "Bus"),
    (4, "Ferry"),
    (7, "Funicular"),
    (11, "Trolleybus"),
    (12, "Monorail"),
]
DEFAULT_ROUTE_TYPE = 3  # blank / non-numeric route_type and unknown codes become Bus

# --- fixed values: operator (agency) selection for a national feed ---
OPERATOR_AGENCY_IDS_NATIONAL = [
    "500000000000000782",
    "500000000000000833",
    "505000000000000001",
    "505000000000000607",
]
OPERATOR_AGENCY_IDS_REGIONAL = ["275", "1:275"]
OPERATOR_NAME_EXACT = "sl"
OPERATOR_NAME_CONTAINS = "ab sl"

# --- fixed values: realtime stop-id family translation (national static, regional realtime) ---
RT_STOP_PREFIX_FROM = "9022"
RT_STOP_PREFIX_TO = "9011"
STATIC_FEED_NATIONAL = "gtfs_sweden_3"
REALTIME_FEED_REGIONAL = "gtfs_regional"
DEFAULT_ZONE = "Europe/Stockholm"

# --- fixed values: fallback match band ---
FALLBACK_START_BAND_SEC = 300

# --- fixed values: data-quality thresholds ---
DELAY_LOWER_BOUND_SEC = -3600
DELAY_UPPER_BOUND_SEC = 10800
MAX_NULL_DELAY_RATE = 0.8
MAX_STATIC_AGE_DAYS = 7

# --- fixed values: energy score ---
W_KM = 0.35
W_HOURS = 0.35
W_STOPS = 0.20
W_DELAY = 0.10
EARTH_RADIUS_KM = 6371.0
MAX_LEG_KM = 25.0
MAX_TRIP_HOURS = 8.0
REGION_MIN_FRACTION = 0.5
RATIO_MIN_DENOMINATOR = 0.05
SCALE_MIN_SPREAD = 1e-12
# region id, display name, bbox (min_lat, max_lat, min_lon, max_lon) or None
REGIONS: list[tuple[str, str, tuple[float, float, float, float] | None]] = [
    ("all", "All stops", None),
    ("inner_stockholm", "Inner Stockholm", (59.30, 59.36, 17.98, 18.12)),
    ("south_stockholm", "South Stockholm", (59.24, 59.31, 17.95, 18.15)),
]
REASON_TAGS = [
    "LONG_DISTANCE",
    "LONG_DURATION",
    "HIGH_STOP_DENSITY",
    "CONGESTION",
    "HIGH_FREQUENCY",
    "SLOW_SPEED",
]
ENERGY_DATA_SOURCE = "estimate_v1"
FACT_DATA_SOURCE = "gtfs_rt"

# --- fixed values: dashboard defaults ---
LATE_THRESHOLD_SEC = 60
VERY_LATE_THRESHOLD_SEC = 300
ROUTE_MIN_OBSERVATIONS = 20
STOP_MIN_OBSERVATIONS = 3
MAP_MIN_OBSERVATIONS = 3
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
EMPTY_COLOR_RANGE = (-5.0, 15.0)
LADDER_MINUTES = [1, 3, 5, 10]
