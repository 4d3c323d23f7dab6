"""Text column expressions: name cleaning, search predicates, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopflow.functions.times import null_placeholder
from stopflow.schema import DEFAULT_TRAIN_TYPE, LABEL_SEPARATOR, MISSING_NAME_TEXT, NAME_PLACEHOLDERS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c: str | Column) -> Column:
    """Trim; blank or ``none`` (any case) becomes null."""
    return null_placeholder(c, NAME_PLACEHOLDERS)


def search_match(columns: list[str], term: str | None, literal: bool = False) -> Column:
    """Case-insensitive search of ``term`` in any of ``columns``.

    The term is stripped and lower-cased; a blank term matches every row.
    By default the term is a regular expression (like a pandas
    ``str.contains``); ``literal=True`` matches it as plain text.  A null
    column value never matches.
    """
    if term is None or not term.strip():
        return F.lit(True)
    t = term.strip().lower()
    preds = [
        (F.lower(_col(c)).contains(F.lit(t)) if literal else F.lower(_col(c)).rlike(t))
        for c in columns
    ]
    out = preds[0]
    for p in preds[1:]:
        out = F.coalesce(out, F.lit(False)) | F.coalesce(p, F.lit(False))
    return F.coalesce(out, F.lit(False))


def category_equals(c: str | Column, value: str | None, all_values: tuple[str, ...] = ("All", "All Categories")) -> Column:
    """Equality filter where ``None`` or an "All" sentinel means no filter."""
    if value is None or value in all_values:
        return F.lit(True)
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def train_label(number: str | Column, name: str | Column, ttype: str | Column) -> Column:
    """``"<number> — <name> (<type>)"``; a null or blank type reads as the default type."""
    return F.concat(
        _col(number), F.lit(LABEL_SEPARATOR), F.coalesce(_col(name), F.lit(MISSING_NAME_TEXT)),
        F.lit(" ("), F.coalesce(F.nullif(_col(ttype), F.lit("")), F.lit(DEFAULT_TRAIN_TYPE)), F.lit(")"),
    )


def label_number(label: str | Column) -> Column:
    """Inverse of :func:`train_label`: the text before the first separator, trimmed."""
    return F.trim(F.split_part(_col(label), F.lit(LABEL_SEPARATOR), F.lit(1)))


def station_label(name: str | Column, code: str | Column) -> Column:
    """``"<station_name> (<code>)"``; without a name the code stands for it, without a code the name stands alone."""
    name, code = _col(name), _col(code)
    return F.when(code.isNull(), name).otherwise(F.concat(F.coalesce(name, code), F.lit(" ("), code, F.lit(")")))
