"""Schema conforming: map raw column names onto the stops vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.schema import ALIASES, REQUIRED


def resolve_columns(columns: list[str], aliases: dict[str, list[str]] = ALIASES) -> dict[str, str]:
    """Target -> source column, first alias present wins (case-insensitive).

    Targets without any matching source are left out.
    """
    by_lower = {}
    for c in columns:
        by_lower.setdefault(c.lower(), c)
    mapping: dict[str, str] = {}
    for target, candidates in aliases.items():
        for cand in candidates:
            if cand.lower() in by_lower:
                mapping[target] = by_lower[cand.lower()]
                break
    return mapping


def check_required(mapping: dict[str, str], columns: list[str] | None = None) -> None:
    """Raise ``ValueError`` naming the required targets that did not resolve.

    A missing station code is accepted when a station name resolved.
    """
    missing = [r for r in REQUIRED if r not in mapping]
    if "station_code" in missing and "station_name" in mapping:
        missing.remove("station_code")
    if missing:
        raise ValueError(f"cannot find required columns {missing}; available: {columns}")


def station_key(columns: list[str]) -> str:
    """The station identifier: the code when present, else the name."""
    return "station_code" if "station_code" in columns else "station_name"


def station_display(columns: list[str]) -> str:
    """The station label column: the name when present, else the code."""
    return "station_name" if "station_name" in columns else station_key(columns)


def train_display(columns: list[str]) -> str:
    """The train label column: the name when present, else the number."""
    return "train_name" if "train_name" in columns else "train_number"


def group_keys(*cols: str) -> list[str]:
    """Distinct grouping keys in order (a fallback may name one column twice)."""
    return list(dict.fromkeys(cols))


def conform_stops(raw: DataFrame, aliases: dict[str, list[str]] = ALIASES) -> DataFrame:
    """Select and rename the resolvable columns; train_number becomes text,
    day an int, and a text stop sequence a number.

    Fails before any Spark job when a required column is missing.
    """
    mapping = resolve_columns(raw.columns, aliases)
    check_required(mapping, raw.columns)
    types = dict(raw.dtypes)
    exprs = []
    for tgt, src in mapping.items():
        c = F.col(f"`{src}`")
        if tgt == "train_number":
            c = c.cast("string")
        elif tgt == "day" and types[src] != "int":
            c = c.try_cast("int")  # a day number, whatever the source typed it as
        elif tgt == "stop_sequence" and types[src] == "string":
            c = c.try_cast("bigint")  # text sequences (CSV) must order numerically
        exprs.append(c.alias(tgt))
    return raw.select(*exprs)


def col_or_null(df: DataFrame, name: str, dtype: str = "string"):
    """``df[name]`` when the column exists, else a typed null (optional columns
    simply do not exist downstream when the source lacks them)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def existing(df: DataFrame, names: list[str]) -> list[str]:
    """The names, in order, that ``df`` has."""
    return [c for c in names if c in df.columns]


def select_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Project ``wanted`` in order, skipping columns the table does not have."""
    return df.select(*[c for c in wanted if c in df.columns])
