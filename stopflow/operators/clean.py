"""Cleaning: placeholder nulls, key filter, exact dedup, dwell minutes.

Every operator here is a narrow ``DataFrame -> DataFrame`` projection or
filter except the de-duplication (:func:`dedup_exact`, :func:`count_copies`),
the one shuffle of the cleaning stage: a hash aggregate over all columns
with map-side combine, so even a row repeated in a third of all input
collapses before it is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stopflow.functions.text import clean_name
from stopflow.functions.times import hh_mm, minutes_between, minutes_since_midnight, null_placeholder
from stopflow.operators.conform import conform_stops, station_key

TIME_COLUMNS = ["arrival", "departure"]
NAME_COLUMNS = ["train_name", "station_name", "station_code"]


def clean_times(df: DataFrame) -> DataFrame:
    """Arrival/departure: trim; blank, none, nan, null (any case) -> null."""
    return df.withColumns({c: null_placeholder(c) for c in TIME_COLUMNS if c in df.columns})


def clean_names(df: DataFrame) -> DataFrame:
    """Train name, station name and code: trim; blank or none -> null.

    The train number is left untouched (neither trimmed nor nulled).
    """
    return df.withColumns({c: clean_name(c) for c in NAME_COLUMNS if c in df.columns})


def drop_missing_keys(df: DataFrame) -> DataFrame:
    """Drop rows without a train number or a station identifier."""
    key = station_key(df.columns)
    return df.filter(F.col("train_number").isNotNull() & F.col(key).isNotNull())


def dedup_exact(df: DataFrame) -> DataFrame:
    """Remove exact duplicate rows (all columns)."""
    return df.dropDuplicates()


def add_duration(df: DataFrame) -> DataFrame:
    """Dwell minutes from the full time text, then cut times to ``HH:MM``.

    The minutes of both times are columns of their own, so that each is
    worked out once a row: in one expression the aggregate below would
    repeat them at every place that uses them.
    """
    timed = df.withColumns({"_arr": minutes_since_midnight("arrival"), "_dep": minutes_since_midnight("departure"),
                            "arrival": hh_mm("arrival"), "departure": hh_mm("departure")})
    return timed.withColumn("stop_duration_mins", minutes_between("_arr", "_dep")).drop("_arr", "_dep")


def normalise(raw: DataFrame) -> DataFrame:
    """Conform names and null out placeholders (no rows removed)."""
    return clean_names(clean_times(conform_stops(raw)))


def clean_stops(raw: DataFrame) -> DataFrame:
    """Raw feed -> cleaned stops (before enrichment)."""
    return add_duration(dedup_exact(drop_missing_keys(normalise(raw))))


@dataclass
class CleanStats:
    """Removal accounting, filled in when the cleaned table is first written."""
    observation: Observation

    def as_dict(self) -> dict[str, int]:
        m = self.observation.get
        # sums over an empty feed are null
        raw, after_filter, cleaned = (m[c] or 0 for c in ("raw_rows", "kept_rows", "cleaned_rows"))
        return {
            "raw_rows": raw,
            "cleaned_rows": cleaned,
            "removed_missing": raw - after_filter,
            "removed_duplicates": after_filter - cleaned,
        }


def count_copies(raw: DataFrame) -> DataFrame:
    """Distinct normalised rows with ``_ok`` (both keys present) and ``_n``
    (number of raw copies).  One hash aggregate: exact de-duplication and
    the removal counts come from the same shuffle."""
    df = normalise(raw)
    key = station_key(df.columns)
    ok = (F.col("train_number").isNotNull() & F.col(key).isNotNull()).alias("_ok")
    return df.groupBy(*df.columns, ok).agg(F.count(F.lit(1)).alias("_n"))


def clean_counted(raw: DataFrame) -> DataFrame:
    """:func:`count_copies` plus dwell minutes.

    :func:`finish_counted` turns this into cleaned stops and the removal
    counts; anything row-preserving (the enrichment joins) may run in
    between.
    """
    return add_duration(count_copies(raw))


def finish_counted(counted: DataFrame) -> tuple[DataFrame, CleanStats]:
    """Keep key-complete rows and observe the removal counts on the way.

    The observation sits directly under the consumer of the result (the
    write), i.e. in the final stage after every shuffle, where Spark applies
    each task's metrics exactly once even when lost executors force earlier
    stages to re-run.
    """
    obs = Observation("clean_stats")
    observed = counted.observe(
        obs,
        F.sum("_n").alias("raw_rows"),
        F.sum(F.when(F.col("_ok"), F.col("_n")).otherwise(0)).alias("kept_rows"),
        F.count_if(F.col("_ok")).alias("cleaned_rows"),
    )
    return observed.filter(F.col("_ok")).drop("_ok", "_n"), CleanStats(obs)


def clean_with_stats(raw: DataFrame) -> tuple[DataFrame, CleanStats]:
    """:func:`clean_stops` plus removal counts collected by the same job."""
    return finish_counted(clean_counted(raw))


def clean_stats_frame(raw: DataFrame) -> DataFrame:
    """Removal accounting as a one-row table, computed in one aggregation.

    Summing the copy counts gives the raw and key-filtered counts; the
    number of key-complete distinct rows is the de-duplicated count.
    """
    return stats_of_groups(count_copies(raw))


def stats_of_groups(groups: DataFrame) -> DataFrame:
    """:func:`clean_stats_frame` of rows that :func:`count_copies` or :func:`clean_counted` made, also after row-preserving joins."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))  # noqa: E731  null over an empty feed
    kept = total(F.when(F.col("_ok"), F.col("_n")).otherwise(0))
    return groups.agg(
        total("_n").alias("raw_rows"),
        F.count_if(F.col("_ok")).alias("cleaned_rows"),
        total(F.when(~F.col("_ok"), F.col("_n")).otherwise(0)).alias("removed_missing"),
        (kept - F.count_if(F.col("_ok"))).alias("removed_duplicates"),
    )


def midnight_crossings(stops: DataFrame) -> DataFrame:
    """Timed stops whose departure falls on the next day."""
    return stops.filter(F.col("stop_duration_mins").isNotNull() & (F.col("departure") < F.col("arrival")))
