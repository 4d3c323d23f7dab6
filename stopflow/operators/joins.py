"""Join planning helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.session import materialize

# A dimension is broadcast only if its rows, as text, have at most this many
# bytes, however few they are.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def byte_size(df: DataFrame) -> int:
    """The bytes of the rows of ``df``: 16 per value and the length of its text.

    One distributed aggregate: a partial sum per partition and a one-row
    merge.
    """
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def byte_size_at_most(df: DataFrame, most: int) -> bool:
    """True when the rows of ``df`` have at most ``most`` bytes by :func:`byte_size`."""
    return byte_size(df) <= most


def unique_on(dim: DataFrame, key: str) -> DataFrame:
    """``dim`` with its key checked while it is used: a key with several rows names itself and fails the job.

    The number of rows per key is carried into the plan of the dimension, so
    the fact table needs no further pass.  Rows without a key match nothing
    and may repeat.
    """
    rest = [c for c in dim.columns if c != key]
    rows = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *(F.first(F.col(f"`{c}`")).alias(c) for c in rest))
    repeated = F.raise_error(F.concat(F.lit(f"several dimension rows for {key} "), F.col(key).cast("string")))
    checked = F.when((F.col("_rows") > 1) & F.col(key).isNotNull(), repeated.cast(dim.schema[key].dataType)).otherwise(F.col(key))
    return rows.select(*(checked.alias(c) if c == key else F.col(f"`{c}`") for c in dim.columns))


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, bound_by: DataFrame | None = None,
                   landed: bool = False) -> DataFrame:
    """Join a (usually small) dimension onto a fact table.

    The dimension is broadcast when its rows are proven to have at most
    ``max_broadcast_bytes``; otherwise it is written once to the shared folder
    and joined by a shuffle join, whose skewed (hot-key) partitions AQE's
    skew-join handling splits into several tasks.  A shuffle partition's part
    of the dimension is hashed while it has at most ``max_broadcast_bytes``;
    beyond that both sides are sorted, and AQE may still broadcast the
    dimension from runtime sizes.

    ``on`` must refer to columns by name (or be a list of names): in the
    shuffle case the dimension is re-read, so attributes bound to ``dim``
    would not resolve.

    ``bound_by`` is a cheaper frame with at least the bytes of ``dim``
    (for example its input before de-duplication): the size check is then
    a scan instead of a second computation of the dimension.
    ``landed=True`` says ``dim`` is already a table read from storage (it is
    not written again).
    """
    size = byte_size(dim if bound_by is None else bound_by)
    if size <= max_broadcast_bytes:
        return fact.join(F.broadcast(dim), on, how)
    # Too big to broadcast: land the dimension once in the shared folder.  Read
    # back, it enters the join through a plain shuffle (an aggregate feeding
    # the join directly would hide it from AQE's skew-join split) and carries
    # real file-size statistics for AQE's own broadcast decision.
    dim = dim if landed else materialize(dim, "join_dimension")
    # A task's part of it, the same in every partition as its keys are hashed,
    # may be held in memory if a broadcast of that size might: then no row of
    # the fact table is sorted for the join.
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fact.join(dim.hint("shuffle_hash") if size <= partitions * max_broadcast_bytes else dim, on, how)
