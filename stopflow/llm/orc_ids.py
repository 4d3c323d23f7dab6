"""Token-ID output: ORC stripes of integer arrays, ordered by document id.

ORC's integer run-length encoding packs the ids, its row indexes and Bloom
filters on ``doc_id`` let readers skip stripes and row groups, and every
stripe is read by a task of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .chunks import encoder
from .common import shuffle_partitions

_FILE = "doc_id long, part int, rel_start long, n_tokens int, ids array<int>"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaced: bool = False,
              partitions: int | None = None, stripe_bytes: int = 64 << 20) -> None:
    """Encode ``docs`` (doc_id, text; other columns are ignored) into ORC files at ``path``.

    Every text, whole, becomes its ids and ``end_id``; a null text counts as
    empty.  Rows lie in ascending ``doc_id`` (null first; rows that share an
    id by a hash of the text, so many can be split) over the files and within.  One shuffle: the texts are
    dealt by ranges of ``doc_id`` before they are encoded, so that finding
    the ranges doesn't encode anything, and each task streams its range into
    its file.  ``part`` numbers the files in order and ``rel_start`` counts
    the ids before a document in its file.
    """
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, spaced), end_id.to_bytes(4, "little")
        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            each = enc.encode_many(b.column(1))
            for at in range(0, b.num_rows, 512):
                s = b.slice(at, 512)
                ids = [next(each) + end for _ in range(s.num_rows)]
                n = [len(x) // 4 for x in ids]
                offsets, starts = [0], []
                for k in n:
                    starts.append(before)
                    before += k
                    offsets.append(offsets[-1] + k)
                values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array([part] * len(n), pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(n, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
                    names=["doc_id", "part", "rel_start", "n_tokens", "ids"])

    n = partitions or shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    place = ("doc_id", F.xxhash64("text"))
    (rows.repartitionByRange(n, *place).sortWithinPartitions(*place, "text")
     .mapInArrow(encoded, _FILE)
     .write.mode("overwrite").option("compression", "zstd")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.stripe.size", str(stripe_bytes)).option("orc.row.index.stride", "2000")
     .orc(path))


def read_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The files' rows; ``doc_ids`` prunes by row indexes and Bloom filters in the scan."""
    rows = spark.read.schema(_FILE).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def id_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids of all documents before it: the ids before
    it in its file and, from one row per file, those of the files before.
    """
    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<i4", copy=False)
            crc = [zlib.crc32(values[s:e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(offsets[1:] - offsets[:-1], pa.int64()),
                 pa.array(crc, pa.int64())], names=["doc_id", "part", "rel_start", "n_tokens", "ids_crc32"])

    rows = read_ids(spark, path)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    out = rows.select("doc_id", "part", "rel_start", "ids").mapInArrow(
        digested, "doc_id long, part int, rel_start long, n_tokens long, ids_crc32 long")
    # one row per output file, so at most as many as the write had partitions
    return out.join(F.broadcast(files), "part").select(
        "doc_id", (F.col("base") + F.col("rel_start")).alias("start"), "n_tokens", "ids_crc32")
