"""Exact de-duplication across batches: a ledger of all rows seen so far.

The ledger holds each distinct row once, whole, in buckets by a hash of all
its columns.  A new batch reads only the buckets that its own rows fall into
and is grouped together with them by all columns: whole rows are compared, so
two rows of one hash are both kept, and each row is shuffled once.  Each
batch's rows are a folder of its own, listed last: a batch that ended early is
unlisted and is done again, and one that runs a second time gets the same rows
back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.operators.clean import add_duration, dedup_exact, drop_missing_keys, normalise
from stopflow.sources.paths import filesystem

LIST, BUCKETS = "_batches", 64
_OLD, _BUCKET = "_old", "_bucket"


def listed_batches(spark: SparkSession, ledger: str) -> list[str]:
    """The batches whose rows are in the ledger."""
    fs, at = filesystem(spark, f"{ledger.rstrip('/')}/{LIST}")
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _stored(spark: SparkSession, ledger: str, batches: list[str], schema) -> DataFrame | None:
    """The rows of ``batches``, with their buckets as a partition column that scans prune by."""
    found = None
    for name in batches:
        rows = spark.read.schema(schema).parquet(f"{ledger.rstrip('/')}/{name}")
        found = rows if found is None else found.unionByName(rows)
    return found


def new_rows(batch: DataFrame, ledger: str, name: str, buckets: int = BUCKETS) -> DataFrame:
    """The distinct rows of ``batch`` that no other listed batch has had; they are then the ledger's too.

    Nulls are equal to each other.  All batches of a ledger must have the same
    columns; ``name`` must be a file name of letters, digits, ``-`` and ``_``,
    and ``buckets`` stays as it was for the first batch.  Batches are taken
    one at a time.  The batch's copies are put together before the shuffle,
    which is by whole rows, so no key can dominate it.
    """
    if not name or not all(c.isalnum() or c in "-_" for c in name) or name.startswith("_"):
        raise ValueError(f"not a batch name: {name!r}")
    spark, columns, root = batch.sparkSession, batch.columns, ledger.rstrip("/")
    quoted = [F.col(f"`{c}`") for c in columns]
    bucket = F.pmod(F.xxhash64(*quoted), F.lit(buckets)).cast("int").alias(_BUCKET)
    rows = batch.select(*quoted)
    kept = rows.select(*quoted, bucket)
    known = listed_batches(spark, root)
    fs, at = filesystem(spark, f"{root}/{LIST}/{name}")
    if name not in known:
        old = _stored(spark, root, known, kept.schema)
        if old is None:
            rows = dedup_exact(rows)
        else:
            # a row or less per bucket, so at most ``buckets`` numbers
            own = [r[0] for r in kept.select(_BUCKET).distinct().collect()]
            seen = old.filter(F.col(_BUCKET).isin(own)).select(*quoted, F.lit(True).alias(_OLD))
            rows = (rows.withColumn(_OLD, F.lit(False)).unionByName(seen).groupBy(*quoted).agg(F.bool_or(_OLD).alias(_OLD))
                    .filter(~F.col(_OLD)).drop(_OLD))
        rows = rows.select(*quoted, bucket)
        rows.write.mode("overwrite").partitionBy(_BUCKET).option("compression", "zstd").parquet(f"{root}/{name}")
        fs.mkdirs(at.getParent())
        fs.create(at, True).close()
    return _stored(spark, root, [name], kept.schema).select(*quoted)


def clean_batch(raw: DataFrame, ledger: str, name: str, buckets: int = BUCKETS) -> DataFrame:
    """The cleaned stops that a batch of the raw feed adds: over any batches together, those of one clean run over all."""
    return add_duration(new_rows(drop_missing_keys(normalise(raw)), ledger, name, buckets))
