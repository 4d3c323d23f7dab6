"""Column expressions for clock times written as ``HH:MM`` / ``HH:MM:SS`` text.

All of them are built-in Spark expressions (no UDF), safe under ANSI mode:
malformed text becomes null instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopflow.schema import ARRIVAL_PERIODS, MINUTES_PER_DAY, TIME_PLACEHOLDERS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_placeholder(c: str | Column, placeholders: list[str] = TIME_PLACEHOLDERS) -> Column:
    """Trim spaces; null if the result, lower-cased, is one of ``placeholders``."""
    t = F.trim(_col(c))
    return F.when(F.lower(t).isin(*placeholders), F.lit(None).cast("string")).otherwise(t)


def to_int_truncating(x: Column) -> Column:
    """Text -> int as the original (non-ANSI) cast read it: surrounding spaces
    allowed, a decimal fraction truncated (``'8.5'`` -> 8), anything else or an
    out-of-range value -> null.  The fraction branch is evaluated only when
    the plain integer cast fails, so clean data pays nothing for it."""
    frac = x.rlike(r"^\s*[+-]?[0-9]+\.[0-9]*\s*$")
    return F.coalesce(x.try_cast("int"), F.when(frac, x.try_cast("decimal(38,10)").try_cast("int")))


def clock_part(c: str | Column, index: int) -> Column:
    """Integer of the ``index``-th ``:``-separated field, null when absent or not a number.

    Fields are cut out as bytes; a ``split`` would decode the text and build
    an array of fields for each use.
    """
    c = _col(c)
    field = F.substring_index(c, ":", index + 1)
    if index > 0:  # with fewer separators, what stands before the last one needed is the whole text
        field = F.when(F.substring_index(c, ":", index) != c, F.substring_index(field, ":", -1))
    return to_int_truncating(field)


def hour_of(c: str | Column) -> Column:
    """Hour of a clock time: the integer before the first ``:``."""
    return clock_part(c, 0)


def minutes_since_midnight(c: str | Column, strict: bool = False) -> Column:
    """``h*60 + m``; seconds are ignored.

    By default hours and minutes are not range-checked (``24:10`` is 1450,
    as in the original data's handling); ``strict=True`` gives null unless
    0 <= h <= 23 and 0 <= m <= 59.
    """
    h, m = clock_part(c, 0), clock_part(c, 1)
    total = h * 60 + m
    if strict:
        return F.when(h.between(0, 23) & m.between(0, 59), total)
    return total


def dwell_minutes(arrival: str | Column, departure: str | Column, strict: bool = False) -> Column:
    """Minutes between arrival and departure, wrapping past midnight.

    Null when either side is null or unparseable (or, with ``strict``, out of
    range).  For valid clock times the result lies in 0..1439.
    """
    return minutes_between(minutes_since_midnight(arrival, strict), minutes_since_midnight(departure, strict))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minutes from one minute of the day to another, wrapping past midnight."""
    a, d = _col(start), _col(end)
    return F.when(d >= a, d - a).otherwise(d + F.lit(MINUTES_PER_DAY) - a).cast("int")


def hh_mm(c: str | Column) -> Column:
    """First five characters of the text (``HH:MM`` of ``HH:MM:SS``)."""
    return F.substring(_col(c), 1, 5)


def hour_label(c: str | Column) -> Column:
    """``HH:00`` for an integer hour."""
    return F.format_string("%02d:00", _col(c))


def in_hour_window(hour: str | Column, start: int, end: int) -> Column:
    """Inclusive hour window; ``start > end`` wraps past midnight (22..5)."""
    h = _col(hour)
    if start <= end:
        return h.between(start, end)
    return (h >= start) | (h <= end)


def in_arrival_period(arrival: str | Column, period: str | None) -> Column:
    """Half-open period test on the arrival hour; ``None``/"All" keeps all rows.

    A null or malformed arrival never matches a named period.
    """
    if period is None or period.lower().startswith("all"):
        return F.lit(True)
    name = next((p for p in ARRIVAL_PERIODS if period.lower().startswith(p.lower())), None)
    if name is None:
        raise ValueError(f"unknown arrival period {period!r}; expected one of {list(ARRIVAL_PERIODS)}")
    lo, hi = ARRIVAL_PERIODS[name]
    h = hour_of(arrival)
    return F.coalesce((h >= lo) & (h < hi), F.lit(False))
