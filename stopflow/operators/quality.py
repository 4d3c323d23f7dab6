"""Data-quality expectations over published tables, as one Spark job each.

Each check yields a row ``(check_name, ok, violations)``.  The checks on
the fact table are computed in one aggregate pass and then unpivoted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.functions.times import hour_of
from stopflow.operators.conform import station_key

REQUIRED_COLUMNS = {
    "stops": ["train_number", "station_code", "arrival", "departure", "stop_duration_mins"],
    "busiest_stations": ["station_code", "station_name", "total_stops", "distinct_trains"],
    "hourly_traffic": ["hour", "arrivals"],
    "stoppage_stats": ["avg_duration_mins", "max_duration_mins", "p90_duration_mins"],
    "longest_trains": ["train_number", "num_stops"],
}


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Required columns of ``table`` that ``df`` lacks (schema check, no job)."""
    return [c for c in REQUIRED_COLUMNS.get(table, []) if c not in df.columns]


def _checks_frame(agg_row: DataFrame, checks: list[tuple[str, str]]) -> DataFrame:
    """Unpivot one aggregate row into (check_name, ok, violations).

    ``checks`` pairs a check name with the aggregate column holding its
    violation count; a check passes when that count is zero.
    """
    stacked = agg_row.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(col).cast("bigint").alias("violations"))
        for name, col in checks
    ])).alias("c"))
    return stacked.select("c.check_name", (F.col("c.violations") == 0).alias("ok"), "c.violations")


def required_columns_check(df: DataFrame, table: str) -> DataFrame:
    """How many required columns of ``table`` are missing (from the schema: no scan)."""
    n = len(missing_columns(df, table))
    one = df.sparkSession.range(1).select(F.lit(n).alias("n"))
    return _checks_frame(one, [(f"{table}_required_columns", "n")])


def _none(present: Column) -> Column:
    """1 unless ``present`` counts something."""
    return F.when(present > 0, 0).otherwise(1)


def stops_checks(stops: DataFrame, station_name: str | Column | None = None,
                 train_number: str | Column | None = None) -> DataFrame:
    """Expectations on the conformed fact table, in one pass.

    With ``station_name`` or ``train_number`` (literals or scalar subqueries,
    e.g. the busiest station) the same pass checks that each has a stop.
    """
    key = station_key(stops.columns)
    dur = F.col("stop_duration_mins")
    h = hour_of("arrival")
    aggs = {
        "stops_non_empty": _none(F.count(F.lit(1))),
        "stop_duration_non_negative": F.count_if(dur < 0),
        "stop_duration_present": _none(F.count(dur)),
        "keys_not_null": F.count_if(F.col("train_number").isNull() | F.col(key).isNull()),
        "arrival_hour_in_0_23": F.count_if(F.col("arrival").isNotNull() & ~F.coalesce(h.between(0, 23), F.lit(False))),
    }
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    if station_name is not None:
        aggs["station_lookup_returns_rows"] = _none(F.count_if(F.col("station_name") == column(station_name)))
    if train_number is not None:
        aggs["train_lookup_returns_rows"] = _none(F.count_if(F.col("train_number") == column(train_number)))
    row = stops.agg(*(a.alias(n) for n, a in aggs.items()))
    return _checks_frame(row, [(n, n) for n in aggs])


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _not(cond: Column) -> Column:
    """True where ``cond`` is false or unknown: a missing value passes no check."""
    return ~F.coalesce(cond, F.lit(False))


def positive_counts_check(df: DataFrame, table: str, columns: list[str], non_negative: list[str] | None = None) -> DataFrame:
    """Non-empty, every counter in ``columns`` present and strictly positive, every one in ``non_negative`` present and not below 0."""
    bad = {f"{table}_counts_positive": _any([_not(F.col(c) > 0) for c in columns])}
    if non_negative:
        bad[f"{table}_values_non_negative"] = _any([_not(F.col(c) >= 0) for c in non_negative])
    row = df.agg(_none(F.count(F.lit(1))).alias(f"{table}_non_empty"), *(F.count_if(c).alias(n) for n, c in bad.items()))
    return _checks_frame(row, [(n, n) for n in (f"{table}_non_empty", *bad)])


def hour_domain_check(dense: DataFrame) -> DataFrame:
    """The dense hourly table has each of the hours 0..23 once, and nothing else."""
    good = F.count_distinct(F.when(F.col("hour").between(0, 23), F.col("hour")))
    row = dense.agg((F.lit(24) - good + F.count(F.lit(1)) - good).alias("bad"))
    return _checks_frame(row, [("hourly_traffic_24_hours", "bad")])


def lookup_check(stops: DataFrame, station_name_col: str, station_name: str | Column,
                 train_number: str | Column) -> DataFrame:
    """The given station (e.g. the busiest) and train each have at least one stop.

    The probes may be literals or scalar-subquery columns.
    """
    stn = station_name if isinstance(station_name, Column) else F.lit(station_name)
    trn = train_number if isinstance(train_number, Column) else F.lit(train_number)
    row = stops.agg(_none(F.count_if(F.col(station_name_col) == stn)).alias("stn"), _none(F.count_if(F.col("train_number") == trn)).alias("trn"))
    return _checks_frame(row, [("station_lookup_returns_rows", "stn"), ("train_lookup_returns_rows", "trn")])


def metrics_check(metrics: DataFrame, positive: list[str], non_negative: list[str], name: str) -> DataFrame:
    """A metrics document: exactly one row, all keys present, counters > 0 (or >= 0); nulls count as violations."""
    missing = [c for c in positive + non_negative if c not in metrics.columns]
    if missing:
        raise ValueError(f"{name} lacks {missing}")
    bad = [_not(F.col(c) > 0) for c in positive] + [_not(F.col(c) >= 0) for c in non_negative]
    row = metrics.agg((F.count_if(_any(bad)) + F.abs(F.count(F.lit(1)) - 1)).alias("bad"))
    return _checks_frame(row, [(f"{name}_values_valid", "bad")])


def dq_report(*frames: DataFrame) -> DataFrame:
    """Union of check tables."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
