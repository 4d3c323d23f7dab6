"""Scalar column expressions (built-in Spark functions only, no UDFs)."""

from stopflow.functions.text import (
    category_equals,
    clean_name,
    label_number,
    search_match,
    station_label,
    train_label,
)
from stopflow.functions.times import (
    clock_part,
    dwell_minutes,
    hh_mm,
    hour_label,
    hour_of,
    in_arrival_period,
    in_hour_window,
    minutes_since_midnight,
    null_placeholder,
)

__all__ = [
    "category_equals", "clean_name", "label_number", "search_match", "station_label", "train_label",
    "clock_part", "dwell_minutes", "hh_mm", "hour_label", "hour_of", "in_arrival_period",
    "in_hour_window", "minutes_since_midnight", "null_placeholder",
]
