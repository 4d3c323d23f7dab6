"""Column vocabulary of the stops data model.

The conformed fact table is ``stops``: one row per scheduled halt of a train
at a station.  Raw inputs name their columns in many ways; ``ALIASES`` maps
each target column to the source names it may appear under.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference for identical resolution) -------
# Target column -> accepted source names, tried in this order, matched
# case-insensitively; the first one present wins.
ALIASES: dict[str, list[str]] = {
    "train_number": ["train_number", "trainno", "train_no", "trainNumber", "number"],
    "train_name": ["train_name", "trainname", "trainName", "name"],
    "station_code": ["station_code", "stationcode", "stationCode", "station", "stn_code"],
    "station_name": ["station_name", "stationname", "stationName", "stn_name"],
    "arrival": ["arrival", "arrival_time", "arrivaltime", "arr"],
    "departure": ["departure", "departure_time", "departuretime", "dep"],
    "day": ["day", "day_number", "dayno", "day_count"],
    "stop_sequence": ["seq", "sequence", "stop_number", "stop_seq", "sno", "serial", "stop_no", "id"],
}
# Targets that must resolve; station_code may be replaced by station_name.
REQUIRED = ["train_number", "station_code", "arrival", "departure"]
# Strings that mean "no time" (compared after trim + lower).
TIME_PLACEHOLDERS = ["", "none", "nan", "null"]
# Strings that mean "no name" (compared after trim + lower).
NAME_PLACEHOLDERS = ["", "none"]
# Column names that get a categorical breakdown (compared lower-case).
BREAKDOWN_DIMENSIONS = ["zone", "state", "train_type", "type", "category"]
# Category values that are placeholders, removed by the *_valid breakdowns.
PLACEHOLDER_CATEGORIES = ["", "?"]
# Minutes in a day; dwell wraps at midnight.
MINUTES_PER_DAY = 1440
# Stations need this many timed stops to appear in the dwell statistics.
MIN_TIMED_STOPS = 20
# Column order of the exported clean dataset.
EXPORT_COLUMNS = [
    "train_number", "train_name", "train_type",
    "station_code", "station_name",
    "arrival", "departure", "stop_sequence", "day",
    "stop_duration_mins", "zone", "state",
]
# Column order of a station timetable.
TIMETABLE_COLUMNS = [
    "train_number", "train_name", "train_type", "station_code", "station_name",
    "arrival", "departure", "stop_duration_mins", "day", "stop_sequence",
]
# Column order of a route itinerary.
ITINERARY_COLUMNS = [
    "stop_sequence", "station_code", "station_name", "arrival", "departure",
    "stop_duration_mins", "day", "state", "zone",
]
# Column order of a route halt profile (with the train key in front).
HALT_PROFILE_COLUMNS = [
    "stop_sequence", "station_code", "station_name", "arrival", "departure",
    "stop_duration_mins", "day", "state",
]
# Arrival periods: name -> half-open hour range [start, end).
ARRIVAL_PERIODS = {
    "Morning": (6, 12),
    "Afternoon": (12, 18),
    "Evening": (18, 24),
    "Night": (0, 6),
}
# Hour-window presets: name -> inclusive (start, end); start > end wraps midnight.
HOUR_PRESETS = {
    "all": (0, 23),
    "morning": (6, 11),
    "midday": (12, 15),
    "evening": (16, 21),
    "overnight": (22, 5),
}
# Label used for a train whose type is missing.
DEFAULT_TRAIN_TYPE = "Rail"
# Train label "<number> — <name> (<type>)": separator, and the text shown for a missing name.
LABEL_SEPARATOR = " — "
MISSING_NAME_TEXT = "None"
# ---------------------------------------------------------------------------

# Conformed fact table, column order as published.
STOPS = T.StructType([
    T.StructField("train_number", T.StringType()),
    T.StructField("train_name", T.StringType()),
    T.StructField("station_code", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("arrival", T.StringType()),
    T.StructField("departure", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("stop_sequence", T.LongType()),
    T.StructField("stop_duration_mins", T.IntegerType()),
    T.StructField("state", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("train_type", T.StringType()),
])

# Raw schedule rows as they arrive in JSON: everything but numbers is text.
RAW_STOPS_JSON = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("trainName", T.StringType()),
    T.StructField("station", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("arrival", T.StringType()),
    T.StructField("departure", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("id", T.LongType()),
])

# GeoJSON feature collections of station and train attributes.
STATION_PROPERTIES = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zone", T.StringType()),
])
TRAIN_PROPERTIES = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("type", T.StringType()),
])


def feature_collection(properties: T.StructType) -> T.StructType:
    """Schema of a GeoJSON FeatureCollection whose features carry ``properties``."""
    feature = T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", properties),
    ])
    return T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("features", T.ArrayType(feature)),
    ])


STATIONS_GEOJSON = feature_collection(STATION_PROPERTIES)
TRAINS_GEOJSON = feature_collection(TRAIN_PROPERTIES)
