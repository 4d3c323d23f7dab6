"""Lookups and summaries behind the station and train explorers.

The explorers work on one station or one train at a time; here each summary
is computed for *all* stations / trains in one aggregation and a lookup is
a filter on top (pushed into the Parquet scan when reading published data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.functions.text import category_equals, search_match, station_label, train_label
from stopflow.functions.times import hour_label, in_arrival_period, in_hour_window
from stopflow.operators.conform import col_or_null, existing, select_existing
from stopflow.operators.ranking import number_within_groups
from stopflow.operators.slicers import route_filter, station_filter
from stopflow.schema import HALT_PROFILE_COLUMNS, ITINERARY_COLUMNS, TIMETABLE_COLUMNS
from stopflow.session import materialize

ROUTE_ORDER = ["stop_sequence", "arrival", "departure"]


# --- hourly window KPIs ----------------------------------------------------

def hourly_window_kpis(hourly: DataFrame, start: int, end: int) -> DataFrame:
    """Arrivals inside the window, their share (%) of all arrivals in the
    table (the null hour of malformed arrivals included), and the number of
    hour bins in the window."""
    inside = F.coalesce(in_hour_window("hour", start, end), F.lit(False))
    w = F.sum(F.when(inside, F.col("arrivals")))
    return hourly.agg(
        w.cast("bigint").alias("window_total"),
        (F.lit(100.0) * w.cast("double") / F.greatest(F.sum("arrivals"), F.lit(1)).cast("double")).alias("window_pct"),
        F.count_if(inside).alias("hour_bins"),
    )


def hourly_peak(hourly: DataFrame) -> DataFrame:
    """The hour with most arrivals (the earliest one on ties)."""
    best = F.max_by(F.struct("hour", "arrivals"), F.struct(F.col("arrivals"), -F.col("hour")))
    return hourly.agg(best.alias("_p")).select(F.col("_p.hour").alias("peak_hour"), F.col("_p.arrivals").alias("arrivals"))


def hourly_share(hourly: DataFrame) -> DataFrame:
    """``HH:00`` label, arrivals and share (%) of the rows passed in.

    The total is a scalar subquery over the same per-hour table (AQE reuses
    its shuffle), so no rows are gathered into a single partition.
    """
    total = F.greatest(hourly.agg(F.sum("arrivals")).scalar(), F.lit(1))
    return hourly.select(hour_label("hour").alias("hour_label"), "arrivals",
                         (F.lit(100.0) * F.col("arrivals") / total).alias("pct"))


# --- stations ----------------------------------------------------------------

def distinct_values(stops: DataFrame, column: str, drop_blank: bool = False) -> DataFrame:
    """Sorted distinct non-null values of ``column`` (optionally without '')."""
    c = F.col(column)
    cond = c.isNotNull() & (c != "") if drop_blank else c.isNotNull()
    return stops.select(column).filter(cond).distinct().orderBy(column)


def station_train_types(stops: DataFrame) -> DataFrame:
    """Per station: its sorted, comma-joined train categories (blank and null
    dropped) - the category choices of every station page at once.  The
    per-station set is bounded by the number of categories."""
    t = F.col("train_type")
    return (stops.filter(t.isNotNull() & (t != "")).groupBy("station_name")
            .agg(F.array_join(F.array_sort(F.collect_set(t)), ",").alias("train_types")))


def station_profiles(stops: DataFrame) -> DataFrame:
    """The station page for every station: a code, services, mean halt
    (1 decimal), distinct trains and category choices.

    The columns that this needs are landed once and aggregated twice: codes,
    categories and halts by (station, code, category), so that text is merged
    of a few rows per station and map task only; and the exact distinct trains
    by (station, train), whose many groups carry no further buffers.  Both
    results have a row per station, put together by one more aggregation (a
    null station name is a station too).
    """
    t, dur = col_or_null(stops, "train_type"), F.col("stop_duration_mins")
    landed = materialize(stops.select(
        "station_name", col_or_null(stops, "station_code").alias("station_code"), dur,
        "train_number", F.when(t.isNotNull() & (t != ""), t).alias("_type")), "station-profiles", "zstd")
    choices = (landed.groupBy("station_name", "station_code", "_type")
               .agg(F.count(F.lit(1)).alias("_n"), F.sum(dur).alias("_s"), F.count(dur).alias("_c"))
               .groupBy("station_name")
               .agg(F.min("station_code").alias("station_code"), F.sum("_n").alias("_n"), F.sum("_s").cast("double").alias("_s"),
                    F.sum("_c").alias("_c"), F.array_join(F.array_sort(F.collect_set("_type")), ",").alias("_types")))
    trains = (landed.select("station_name", "train_number").distinct()
              .groupBy("station_name").agg(F.count("train_number").alias("_trains")))
    one = lambda c: F.max(c)  # noqa: E731  the one value among a station's two rows
    return (choices.unionByName(trains, allowMissingColumns=True).groupBy("station_name")
            .agg(one("station_code").alias("station_code"), one("_n").alias("services"),
                 F.round(F.try_divide(one("_s"), one("_c").cast("double")), 1).alias("avg_halt_mins"),
                 one("_trains").alias("distinct_trains"), one("_types").alias("train_types")))


def station_timetable(stops: DataFrame, station_name: str, train_type: str | None = None,
                      min_halt: int = 0, period: str | None = None) -> DataFrame:
    """All halts at one station with the timetable slicers, by arrival (nulls last)."""
    pred = None if period is None else in_arrival_period("arrival", period)
    df = station_filter(stops, station_name, train_type, min_halt, pred)
    df = select_existing(df, TIMETABLE_COLUMNS)
    return df.orderBy(F.col("arrival").asc_nulls_last(), *existing(df, ["train_number", "stop_sequence"]))


def station_matches(stops: DataFrame, station_name: str, train_type: str | None = None,
                    min_halt: int = 0, period: str | None = None) -> DataFrame:
    """How many halts of one station the timetable slicers leave: (matched)."""
    pred = None if period is None else in_arrival_period("arrival", period)
    return station_filter(stops, station_name, train_type, min_halt, pred).agg(F.count(F.lit(1)).alias("matched"))


def station_card(stops: DataFrame) -> DataFrame:
    """Per station name: a code, number of services and mean halt (1 decimal).

    Two steps so the pass over all stops is a hash aggregate on
    (name, code) with numeric buffers; only the station-sized result goes
    through the sort-based ``min`` over text.
    """
    dur = F.col("stop_duration_mins")
    pairs = stops.groupBy("station_name", col_or_null(stops, "station_code").alias("station_code")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(dur).alias("_s"), F.count(dur).alias("_c"))
    return pairs.groupBy("station_name").agg(
        F.min("station_code").alias("station_code"),
        F.sum("_n").alias("services"),
        F.round(F.try_divide(F.sum("_s").cast("double"), F.sum("_c").cast("double")), 1).alias("avg_halt_mins"),
    )


# --- trains ------------------------------------------------------------------

def _route_key(stops: DataFrame) -> Column:
    """Where a stop stands on its route: (stop_sequence, arrival, departure), ties by what is shown of it.

    All that is taken from a train's first or last stop goes by this one key,
    so it comes from one row, the same on every run.
    """
    ties = ["station_code", "station_name", "train_name", "train_type"]
    return F.struct(*(existing(stops, ROUTE_ORDER) + existing(stops, ties) or ["train_number"]))


def _endpoint(stops: DataFrame) -> Column:
    if "station_code" in stops.columns and "station_name" in stops.columns:
        return station_label("station_name", "station_code")
    return F.col("station_name" if "station_name" in stops.columns else "station_code")


def train_catalog(stops: DataFrame) -> DataFrame:
    """One row per train, in the order of train_number: name and type of its first stop, and a label.

    ``min_by`` is an ordinary aggregate (partial aggregation before the
    shuffle), so a train with very many stops costs one row per map task.
    Only the catalogue, a row per train, is sorted; filters keep the order.
    """
    first = F.min_by(F.struct(col_or_null(stops, "train_name").alias("train_name"),
                              col_or_null(stops, "train_type").alias("train_type")), _route_key(stops))
    cat = stops.groupBy("train_number").agg(first.alias("_f")).select(
        "train_number", F.col("_f.train_name").alias("train_name"), F.col("_f.train_type").alias("train_type"))
    return cat.withColumn("label", train_label("train_number", "train_name", "train_type")).orderBy("train_number")


def train_search(catalog: DataFrame, term: str | None = None, train_type: str | None = None,
                 literal: bool = False) -> DataFrame:
    """Catalogue rows matching a category ("All" = any) and a number/name search."""
    df = catalog
    if train_type is not None and train_type not in ("All", "All Categories"):
        df = df.filter(category_equals("train_type", train_type))
    if term is not None and term.strip():
        df = df.filter(search_match(["train_number", "train_name"], term, literal))
    return df


def train_search_fallback(catalog: DataFrame, term: str | None = None, train_type: str | None = None,
                          literal: bool = False) -> DataFrame:
    """Like :func:`train_search`, but the whole catalogue when nothing matches.

    The "any match?" test is an ``EXISTS`` scalar subquery over the catalogue,
    not a join.
    """
    hits = train_search(catalog, term, train_type, literal)
    if hits is catalog:
        return catalog
    pred = F.lit(True)
    if train_type is not None and train_type not in ("All", "All Categories"):
        pred = pred & category_equals("train_type", train_type)
    if term is not None and term.strip():
        pred = pred & search_match(["train_number", "train_name"], term, literal)
    return catalog.filter(pred | ~hits.exists())


def route_itinerary(stops: DataFrame, train_number: str, states: list[str] | None = None,
                    zones: list[str] | None = None, min_halt: int = 0) -> DataFrame:
    """One train's halts in route order with the route slicers."""
    df = route_filter(stops.filter(F.col("train_number") == F.lit(train_number)), states, zones, min_halt)
    order = existing(df, ROUTE_ORDER)
    return select_existing(df.orderBy(*order) if order else df, ITINERARY_COLUMNS)


def route_halt_number(stops: DataFrame) -> DataFrame:
    """Every halt, with its station and times, and its 1..n position along its train's route.

    Halts that agree in the route order are numbered by the remaining columns,
    so numbers are the same on every run.
    """
    shown = existing(stops, ["stop_sequence", "station_code", "station_name", "arrival", "departure"])
    first = existing(stops, ROUTE_ORDER)
    order = [F.col(c).asc() if c == "stop_sequence" else F.col(c).asc_nulls_first() for c in [*first, *(c for c in shown if c not in first)]]
    return number_within_groups(stops.select("train_number", *shown), "train_number", order, "halt_no")


def route_halt_profile(stops: DataFrame, states: list[str] | None = None, zones: list[str] | None = None,
                       min_halt: int = 0) -> DataFrame:
    """Timed halts of every train (the halt-duration profile data)."""
    df = route_filter(stops, states, zones, min_halt).filter(F.col("stop_duration_mins").isNotNull())
    return select_existing(df, ["train_number", *HALT_PROFILE_COLUMNS])


def route_summary(stops: DataFrame) -> DataFrame:
    """Per train: halts, journey days (1 when unknown), distinct states and zones.

    The per-train distinct sets are bounded by the number of states/zones,
    so ``collect_set`` stays small and is merged map-side.
    """
    def n_distinct(c: str):
        return F.size(F.collect_set(c)).cast("bigint") if c in stops.columns else F.lit(0).cast("bigint")

    return stops.groupBy("train_number").agg(
        F.count(F.lit(1)).alias("total_halts"),
        F.coalesce(F.max(col_or_null(stops, "day", "int")), F.lit(1)).alias("journey_days"),
        n_distinct("state").alias("states"),
        n_distinct("zone").alias("zones"),
    )


def route_endpoints(stops: DataFrame) -> DataFrame:
    """Per train: origin and destination ``"<name> (<code>)"`` by stop order (stop_sequence, arrival, departure)."""
    lab, key = _endpoint(stops), _route_key(stops)
    return stops.groupBy("train_number").agg(
        F.min_by(lab, key).alias("origin"),
        F.max_by(lab, key).alias("destination"),
    )


def route_regions(stops: DataFrame, column: str = "state") -> DataFrame:
    """Per train: sorted distinct non-null values of ``column``, comma-joined
    (no rows when the table has no such column)."""
    if column not in stops.columns:
        return stops.select("train_number", F.lit(None).cast("string").alias(f"{column}s")).limit(0)
    return (stops.filter(F.col(column).isNotNull()).groupBy("train_number")
            .agg(F.array_join(F.array_sort(F.collect_set(column)), ",").alias(f"{column}s")))


def train_profiles(stops: DataFrame) -> DataFrame:
    """Everything the train explorer shows, for every train, in one aggregation.

    Per train: name, type and label of the first stop; halts; journey days;
    distinct states and zones (counts and sorted lists, null when none);
    origin and destination.  One shuffle on the train number with partial
    aggregation - a train with a third of all stops still sends one row per
    map task - and the per-train sets are bounded by the number of regions.
    """
    lab, end_key = _endpoint(stops), _route_key(stops)
    first = F.min_by(F.struct(col_or_null(stops, "train_name").alias("train_name"),
                              col_or_null(stops, "train_type").alias("train_type")), end_key)
    agg = stops.groupBy("train_number").agg(
        first.alias("_f"),
        F.count(F.lit(1)).alias("total_halts"),
        F.coalesce(F.max(col_or_null(stops, "day", "int")), F.lit(1)).alias("journey_days"),
        F.collect_set(col_or_null(stops, "state")).alias("_st"),
        F.collect_set(col_or_null(stops, "zone")).alias("_zn"),
        F.min_by(lab, end_key).alias("origin"),
        F.max_by(lab, end_key).alias("destination"),
    )

    def joined(c):
        return F.when(F.size(c) > 0, F.array_join(F.array_sort(c), ","))

    return agg.select(
        "train_number", F.col("_f.train_name").alias("train_name"), F.col("_f.train_type").alias("train_type"),
        train_label("train_number", "_f.train_name", "_f.train_type").alias("label"),
        "total_halts", "journey_days",
        F.size("_st").cast("bigint").alias("states"), F.size("_zn").cast("bigint").alias("zones"),
        joined(F.col("_st")).alias("state_list"), joined(F.col("_zn")).alias("zone_list"),
        "origin", "destination",
    )
