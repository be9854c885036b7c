"""Column names, types and the fixed values the cleaning rules use."""

from __future__ import annotations

# Model features (fitted) and fare columns (used only for labels and summaries),
# in the order of the training row.
FEATURES = ["weekday", "hour", "pu_lon", "pu_lat", "do_lon", "do_lat", "trip_min"]
FARES = ["fare", "surcharge", "tip", "toll", "distance"]
TRIP_COLUMNS = ["trip_id"] + FEATURES + FARES

# Layout of one raw trip line and the accepted ranges.
RAW_ARITY = 17
RAW_POSITIONS = {
    "medallion": 0,
    "hack_license": 1,
    "pickup_datetime": 2,
    "secs": 4,
    "distance": 5,
    "pu_lon": 6,
    "pu_lat": 7,
    "do_lon": 8,
    "do_lat": 9,
    "fare": 11,
    "surcharge": 12,
    "tip": 14,
    "toll": 15,
}
DEFAULT_BOUNDS = {
    "fare": (1.0, 600.0),
    "lon": (-80.0, -71.0),
    "lat": (40.0, 45.0),
}
# Segment quantiles: top level at q75, bottom level below q25 (q50 reported only).
LABEL_QUANTILES = (0.75, 0.5, 0.25)
# The k the sweep settled on.
DEFAULT_K = 5
SWEEP_KS = tuple(range(2, 21))
