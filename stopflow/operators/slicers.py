"""Interactive slicers re-expressed as composable DataFrame filters.

Each slicer takes a result table (or ``stops``) and returns a filtered /
limited DataFrame.  Parameters that mean "no filter" (blank search, "All",
empty lists, a zero threshold) add no predicate at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.functions.text import category_equals, search_match
from stopflow.functions.times import in_hour_window
from stopflow.operators.analytics import top_n
from stopflow.operators.conform import station_display
from stopflow.schema import HOUR_PRESETS, PLACEHOLDER_CATEGORIES


def search(df: DataFrame, columns: list[str], term: str | None, literal: bool = False) -> DataFrame:
    """Rows where ``term`` occurs in any of ``columns`` that exist (case-insensitive)."""
    if term is None or not term.strip():
        return df
    cols = [c for c in columns if c in df.columns]
    return df.filter(search_match(cols, term, literal)) if cols else df.limit(0)


def busiest_search(busiest: DataFrame, term: str | None, n: int = 20, literal: bool = False) -> DataFrame:
    """Search inside the busiest-stations table, then keep the first ``n``."""
    hits = search(busiest, ["station_name", "station_code"], term, literal)
    return top_n(hits, n, "total_stops", [c for c in ("station_code", "station_name") if c in busiest.columns])


def stoppage_filtered(stats: DataFrame, min_stops: int = 50, min_avg: float = 10.0) -> DataFrame:
    """Stations with at least ``min_stops`` timed stops and mean dwell >= ``min_avg``."""
    return stats.filter((F.col("num_stops") >= min_stops) & (F.col("avg_duration_mins") >= min_avg))


def stoppage_search(stats: DataFrame, term: str | None, min_stops: int = 50, min_avg: float = 10.0,
                    literal: bool = False) -> DataFrame:
    """Thresholds plus a station name/code search."""
    return search(stoppage_filtered(stats, min_stops, min_avg), ["station_name", "station_code"], term, literal)


def stoppage_topn(stats: DataFrame, n: int = 25, min_stops: int = 50, min_avg: float = 10.0,
                  term: str | None = None) -> DataFrame:
    """The ``n`` longest mean dwells among the filtered stations."""
    keys = [c for c in ("station_code", "station_name") if c in stats.columns]
    return top_n(stoppage_search(stats, term, min_stops, min_avg), n, "avg_duration_mins", keys)


def stoppage_match_counts(stats: DataFrame, n: int = 25, min_stops: int = 50, min_avg: float = 10.0,
                          term: str | None = None) -> DataFrame:
    """How many stations match the slicers and how many of them are shown."""
    m = stoppage_search(stats, term, min_stops, min_avg)
    return m.agg(F.count(F.lit(1)).alias("matched")).select(
        "matched", F.least(F.col("matched"), F.lit(n).cast("bigint")).alias("displayed"))


def stoppage_bounds(stats: DataFrame, floor_max: float = 25.0) -> DataFrame:
    """Slider bounds: largest stop count, largest mean dwell, and the dwell
    slider's upper end ``max(floor_max, round(largest mean))``."""
    return stats.agg(
        F.max("num_stops").alias("max_num_stops"),
        F.max("avg_duration_mins").alias("max_avg"),
    ).select("max_num_stops", "max_avg",
             F.greatest(F.lit(float(floor_max)), F.round(F.col("max_avg")).cast("double")).alias("slider_max"))


def hour_window(hourly: DataFrame, start: int, end: int) -> DataFrame:
    """Hours in the inclusive window; ``start > end`` wraps midnight."""
    return hourly.filter(F.coalesce(in_hour_window("hour", start, end), F.lit(False)))


def hour_preset(hourly: DataFrame, preset: str) -> DataFrame:
    """A named window: all, morning, midday, evening, overnight."""
    start, end = HOUR_PRESETS[preset]
    return hour_window(hourly, start, end)


def valid_categories(bd: DataFrame, dim: str, n: int) -> DataFrame:
    """Breakdown without null, blank or ``'?'`` categories, top ``n`` by stops."""
    c = F.col(dim)
    kept = bd.filter(c.isNotNull() & ~c.isin(*PLACEHOLDER_CATEGORIES))
    return top_n(kept, n, "total_stops", [dim])


def station_filter(stops: DataFrame, station_name: str | None = None, train_type: str | None = None,
                   min_halt: int = 0, period_predicate=None) -> DataFrame:
    """Station timetable slicers: station, category ("All" = any), minimum
    halt (applied only when > 0, which drops untimed stops), arrival period."""
    df = stops
    if station_name is not None:  # the station is looked up by its display column
        df = df.filter(F.col(station_display(df.columns)) == F.lit(station_name))
    if train_type is not None and train_type not in ("All", "All Categories"):
        df = df.filter(category_equals("train_type", train_type)) if "train_type" in df.columns else df.limit(0)
    if min_halt and min_halt > 0:
        df = df.filter(F.col("stop_duration_mins") >= min_halt)
    if period_predicate is not None:
        df = df.filter(period_predicate)
    return df


def route_filter(stops: DataFrame, states: list[str] | None = None, zones: list[str] | None = None,
                 min_halt: int = 0) -> DataFrame:
    """Route slicers: state and zone IN-lists (empty = any), minimum halt."""
    df = stops
    for col, values in (("state", states), ("zone", zones)):
        if values:  # a list on a missing column matches nothing
            df = df.filter(F.col(col).isin(*values)) if col in df.columns else df.limit(0)
    if min_halt and min_halt > 0:
        df = df.filter(F.col("stop_duration_mins") >= min_halt)
    return df
