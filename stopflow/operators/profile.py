"""Profiling of raw inputs: schema, counts, null-like values, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def profile_schema(spark: SparkSession, df: DataFrame, dataset: str = "input") -> DataFrame:
    """One row per column: dataset, position, name, type, nullable.

    Built from the schema on the driver (no Spark job over the data).
    """
    rows = [F.struct(F.lit(dataset).alias("dataset"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(f.nullable).alias("nullable"))
            for i, f in enumerate(df.schema.fields)]
    # literal rows built JVM-side (no Python worker for such a small table)
    return spark.range(1).select(F.inline(F.array(*rows)))


def null_like(c: str):
    """A value counted as missing: SQL null, or text exactly ``''`` or ``'None'``."""
    s = F.col(f"`{c}`").cast("string")
    return F.col(f"`{c}`").isNull() | (s == "") | (s == "None")


def profile_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column in one pass: (column_name, nulls, pct).

    ``pct`` is ``100 * nulls / max(rows, 1)`` rounded to one decimal.
    One aggregate computes every column's count; ``unpivot`` turns the
    single wide row into one row per column.
    """
    cols = columns or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(null_like(c)).alias(f"n{i}") for i, c in enumerate(cols)])
    stacked = counts.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(cols)
    ])).alias("s"))
    return stacked.select(
        F.col("s.column_name").alias("column_name"),
        F.col("s.nulls").alias("nulls"),
        F.round(F.lit(100.0) * F.col("s.nulls") / F.greatest(F.col("_rows"), F.lit(1)), 1).alias("pct"),
    )


def profile_sample(df: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; with ``order`` the pick is deterministic (top-N, not a full sort)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def profile_dataset(df: DataFrame, dataset: str) -> DataFrame:
    """One row: dataset name, row count, column count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dataset).alias("dataset"), "row_count", F.lit(len(df.columns)).cast("int").alias("col_count"))


def profile_datasets(frames: dict[str, DataFrame]) -> DataFrame:
    """Per-dataset summary across all inputs (one aggregate per dataset, unioned)."""
    parts = [profile_dataset(df, name) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_columns(df: DataFrame) -> DataFrame:
    """The per-column inspection report: position, name, type and nullability
    from the schema, with each column's null-like count and share from one
    pass over the data (:func:`profile_nulls`).  The schema facts are attached
    as literal lookups keyed by column name - no join."""
    fields = df.schema.fields
    pos = F.create_map(*[x for i, f in enumerate(fields) for x in (F.lit(f.name), F.lit(i))])
    typ = F.create_map(*[x for f in fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    nul = F.create_map(*[x for f in fields for x in (F.lit(f.name), F.lit(f.nullable))])
    nulls = profile_nulls(df)
    name = F.col("column_name")
    return nulls.select(pos[name].alias("position"), name, typ[name].alias("data_type"),
                        nul[name].alias("nullable"), "nulls", "pct")
