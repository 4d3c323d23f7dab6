"""Best-fit packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopflow.session import materialize

from .chunks import encoder
from .common import shuffle_partitions

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, spaced: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every row of ``docs`` (doc_id, text).

    A document is its text's ids and ``end_id``; a null text is empty.  Only
    one longer than ``capacity`` is cut: a first piece of what is left over,
    then whole sequences.  Ids stay in the task that makes them.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, spaced), end_id.to_bytes(4, "little")
        for b in batches:
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode_many(b.column(1)), strict=True):
                ids += end
                n, at, piece = len(ids) // 4, 0, 0
                while at < n:
                    size = min(n - at, (n - at) % capacity or capacity)
                    rows.append((doc_id, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)])))
                    at, piece = at + size, piece + 1
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(cut, _PIECE)


def ranked(rows: DataFrame, size: str, key: str, salts: int) -> DataFrame:
    """Adds ``rank``: 0, 1, ... among the rows of equal ``size``.

    Sizes are whole numbers up to the capacity, so one may hold most rows:
    rows are numbered within (size, salt), and the salts' counts, at most
    capacity times salts rows, give each salt its first number.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    before = Window.partitionBy(size).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (salted.groupBy(size, "_salt").agg(F.count("*").alias("_n"))
            .select(F.col(size).alias("_size"), F.col("_salt").alias("_s"),
                    F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    own = Window.partitionBy(size, "_salt").orderBy(key)
    numbered = salted.withColumn("_k", F.row_number().over(own) - 1)
    return (numbered.join(F.broadcast(base), (F.col(size) == F.col("_size")) & (F.col("_salt") == F.col("_s")))
            .withColumn("rank", F.col("_base") + F.col("_k")).drop("_salt", "_size", "_s", "_base", "_k"))


def successor_sweep(items: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks of documents go to which ranks of gaps in one round.

    ``items`` and ``gaps`` count documents by length and gaps by size.  From
    the longest length down, documents take the smallest gaps that hold them,
    as many of one length to a gap as fit, and each gap serves one length a
    round.  Conflicts are settled by rank: (length, first rank, end rank, gap,
    first gap rank, documents per gap) means that rank r goes to gap rank
    first gap rank + (r - first rank) // per gap.
    """
    left, used, out = dict(gaps), dict.fromkeys(gaps, 0), []
    sizes = sorted(gaps)
    for length in sorted(items, reverse=True):
        rank, end = 0, items[length]
        for gap in sizes:
            if rank == end:
                break
            if gap < length or not left[gap]:
                continue
            per = gap // length
            take = min(end - rank, left[gap] * per)
            bins = -(-take // per)
            out.append((length, rank, rank + take, gap, used[gap], per))
            rank, left[gap], used[gap] = rank + take, left[gap] - bins, used[gap] + bins
    return out


def _openers(items: dict[int, int], largest_gap: int, capacity: int) -> dict[int, int]:
    """How many documents of each length open a sequence of their own.

    Documents longer than every gap can't ever be placed in one.  As many
    sequences as those need at least are opened, by the longest of them.
    """
    waiting = {k: n for k, n in items.items() if k > largest_gap and n}
    need = max(sum(n for k, n in waiting.items() if 2 * k > capacity),
               -(-sum(k * n for k, n in waiting.items()) // capacity))
    out = {}
    for k in sorted(waiting, reverse=True):
        out[k] = min(waiting[k], need)
        need -= out[k]
    return {k: n for k, n in out.items() if n}


def _counts(rows: DataFrame, size: str) -> dict[int, int]:
    """Rows by size: at most as many numbers as the capacity."""
    return {int(r[0]): int(r[1]) for r in rows.groupBy(size).count().collect()}


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A broadcast table of at most twice the capacity rows."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def best_fit(items: DataFrame, capacity: int = 1024) -> DataFrame:
    """key, sequence_id, offset for ``items`` (key long, distinct; length long, 1 to capacity).

    Bulk-synchronous best fit.  Documents and gaps are ranked by size, each
    once per round over all tasks; a round
    1. counts waiting documents and gaps by size (at most ``capacity``
       numbers each) and sweeps from the longest documents to their successor
       gaps, which gives ranges of ranks;
    2. joins documents to gaps by (gap, rank), so every gap serves one length
       and conflicts are settled by rank;
    3. updates the gaps, and lets documents that no gap can ever hold open as
       many new sequences as they need at least;
    and rounds repeat until nothing waits.  A sequence is named after the key
    of the document that opened it, and fills from offset 0 without holes.

    Documents keep their ranks; those of a length are placed in the order of
    rank, so the waiting ones are known by how many went before.  The gaps
    and each round's placements are written to the shared folder.  The rounds
    needed depend on the spread of lengths, not on the number of documents.
    """
    spark = items.sparkSession
    salts = min(256, shuffle_partitions(spark))
    whole = items.filter(F.col("length") == capacity).select(
        "key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    parts = materialize(ranked(items.filter(F.col("length") < capacity), "length", "key", salts), "ranked")
    total = _counts(parts, "length")
    gone = dict.fromkeys(total, 0)
    placed, bins = [whole], None
    while True:
        waiting = {k: n - gone[k] for k, n in total.items() if n > gone[k]}
        if not waiting:
            break
        step, sweep = [], []
        if bins is not None:
            gaps = _counts(bins, "gap")
            sweep = successor_sweep(waiting, gaps)
        if sweep:
            ranges = _table(spark, [(k, gone[k] + a, gone[k] + b, g, f, p) for k, a, b, g, f, p in sweep],
                            "m_length long, low long, high long, m_gap long, first long, per long")
            met = (parts.join(ranges, (F.col("length") == F.col("m_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
                   .select("key", "length", "m_gap", (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("per"))).alias("m_rank"),
                           ((F.col("rank") - F.col("low")) % F.col("per")).alias("slot")))
            at = ranked(bins, "gap", "sequence_id", salts)
            step.append(met.join(at, (F.col("m_gap") == F.col("gap")) & (F.col("m_rank") == F.col("rank")))
                        .select("key", "sequence_id", "length", (F.lit(capacity) - F.col("gap") + F.col("slot") * F.col("length")).alias("offset")))
            for k, a, b, *_ in sweep:
                gone[k] += b - a
                waiting[k] -= b - a
        largest = max(_after(gaps, sweep), default=0) if bins is not None else 0
        openers = _openers(waiting, largest, capacity)
        if openers:
            ranges = _table(spark, [(k, gone[k], gone[k] + n) for k, n in openers.items()], "m_length long, low long, high long")
            step.append(parts.join(ranges, (F.col("length") == F.col("m_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
                        .select("key", F.col("key").alias("sequence_id"), "length", F.lit(0).cast("long").alias("offset")))
            for k, n in openers.items():
                gone[k] += n
        new = step[0]
        for more in step[1:]:
            new = new.unionByName(more)
        new = materialize(new, "placed")
        placed.append(new.select("key", "sequence_id", "offset"))
        filled = new.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
        if bins is None:
            bins = filled.select("sequence_id", (F.lit(capacity) - F.col("filled")).alias("gap"))
        else:
            # new sequences have had the whole capacity as their gap
            old = bins.select("sequence_id", F.col("gap").alias("old"))
            bins = filled.join(old, "sequence_id", "full").select(
                "sequence_id", (F.coalesce("old", F.lit(capacity)) - F.coalesce("filled", F.lit(0))).alias("gap"))
        bins = materialize(bins.filter("gap > 0"), "gaps")
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def _after(gaps: dict[int, int], sweep: list[tuple]) -> list[int]:
    """The sizes of the gaps that a sweep leaves."""
    left, sizes = dict(gaps), set()
    for length, low, high, gap, _, per in sweep:
        n = high - low
        left[gap] -= -(-n // per)
        sizes |= {gap - per * length} if n >= per else set()
        sizes |= {gap - n % per * length} if n % per else set()
    return [g for g in sizes | {g for g, n in left.items() if n} if g]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, spaced: bool = True) -> DataFrame:
    """Every document's pieces and their places in sequences of ``capacity`` tokens.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Rows that share a doc_id are documents of their own (their pieces can be
    told apart by sequence_id and offset); null ids stay null; a null or
    empty text is a document of just ``end_id``; other columns are ignored;
    an empty table gives no rows.  The pieces are written once with a key of
    their own, so a task that runs again can't number them differently.
    """
    pieces = tokenized_pieces(docs, tokenizer, end_id, capacity, spaced)
    pieces = materialize(pieces.withColumn("key", F.monotonically_increasing_id()), "pieces")
    places = best_fit(pieces.select("key", "length"), capacity)
    return pieces.join(places, "key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
