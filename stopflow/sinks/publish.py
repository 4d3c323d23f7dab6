"""Publishing: Parquet tables, CSV exports, one-row metric documents.

Large tables are written by every task in parallel (file count follows the
data; ``maxRecordsPerFile`` caps file size).  Only results that are small
by construction (top-N lists, per-hour tables, one-row metrics) are
collapsed to a single file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.operators.conform import select_existing
from stopflow.schema import EXPORT_COLUMNS

DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE, partition_by: list[str] | None = None,
                cluster_by: list[str] | None = None, bloom_filter_columns: list[str] | None = None,
                compression: str = "zstd") -> None:
    """Write a (possibly large) table as Parquet, all tasks in parallel.

    ``cluster_by`` sorts each task's output (no shuffle), so the Parquet
    min/max statistics of each row group cover a narrow key range and
    equality / range lookups on the first key skip most row groups.
    ``bloom_filter_columns`` adds Parquet bloom filters, which let equality
    lookups skip row groups on high-cardinality keys without any ordering
    (low-cardinality chunks are dictionary-encoded and skipped via the
    dictionary instead).  ``zstd`` compresses the (many times re-read) fact
    table markedly better than the default snappy at a small CPU cost.
    """
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    w = df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).option("compression", compression)
    for c in bloom_filter_columns or []:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if bloom_filter_columns:
        # size each filter from the distinct values actually written (not a fixed 1 MB)
        w = w.option("parquet.bloom.filter.adaptive.enabled", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_small(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a small result as one file (top-N lists, summaries)."""
    w = df.coalesce(1).write.mode(mode)
    if fmt == "json":
        w.json(path)
    elif fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None, single_file: bool = False,
               mode: str = "overwrite") -> None:
    """CSV with header in the given column order (UTF-8), restricted to existing columns.

    Quotes inside a field are doubled, so any CSV reader reads them back.
    """
    out = select_existing(df, columns) if columns else df
    if single_file:
        out = out.coalesce(1)
    (out.write.mode(mode).option("header", True).option("encoding", "UTF-8").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def export_clean(stops: DataFrame) -> DataFrame:
    """The clean dataset in export column order."""
    return select_existing(stops, EXPORT_COLUMNS)


def metrics_frame(spark, metrics: dict) -> DataFrame:
    """A one-row DataFrame of literals (built JVM-side: no Python worker)."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in metrics.items()])


def write_metrics(spark, metrics: dict, path: str) -> DataFrame:
    """Write a small dict of counters as a one-row JSON document and return it."""
    df = metrics_frame(spark, metrics)
    write_small(df, path, fmt="json")
    return df
