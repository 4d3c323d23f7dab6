"""Token counts from pre-token frequencies.

A pre-token here is a maximal run without space or line feed: the tokenizer
drops white space and never merges across it, so a text's count is the sum
over its pre-tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.session import materialize

from .chunks import encoder, words
from .common import text_bytes

_BLOCK = "block long, shard int, payload binary"


class _Numbered(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _pack(*arrays: np.ndarray) -> bytes:
    raw = b"".join(len(a).to_bytes(8, "little") + np.dtype(a.dtype).str.encode().ljust(4) + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unpack(payload: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(payload), 0, []
    while at < len(raw):
        n, kind = int.from_bytes(raw[at:at + 8], "little"), np.dtype(raw[at + 8:at + 12].decode().strip())
        out.append(np.frombuffer(raw, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def _blocks(block_bytes: int, shards: int):
    """Turns rows of (doc_id, text) into blocks: one row of frequencies, and a row of pre-tokens per shard."""
    def block(number: int, ids, sizes, rows, numbers: _Numbered) -> pa.RecordBatch:
        names = list(numbers)
        shard = np.fromiter((xxhash.xxh32_intdigest(w) % shards for w in names), np.int64, len(names))
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        indptr, index, freq = [0], [], []
        for r in rows:
            u, c = np.unique(place[r], return_counts=True)
            index.append(np.diff(u, prepend=0))
            freq.append(c)
            indptr.append(indptr[-1] + len(u))
        null = np.array([i is None for i in ids], np.uint8)
        parts = [_pack(np.array([i or 0 for i in ids], np.int64), null, np.array(sizes, np.int64),
                       np.array(indptr, np.int64), np.concatenate([*index, []]).astype(np.int32),
                       np.concatenate([*freq, []]).astype(np.int32))]
        which = [-1]
        for s in range(shards):
            if ends[s] < ends[s + 1]:
                which.append(s)
                text = "\n".join(names[i] for i in order[ends[s]:ends[s + 1]])
                parts.append(zstandard.ZstdCompressor(level=3).compress(text.encode()))
        return pa.RecordBatch.from_arrays(
            [pa.array([number] * len(parts), pa.int64()), pa.array(which, pa.int32()), pa.array(parts, pa.binary())],
            names=["block", "shard", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        ids, sizes, rows, numbers = [], [], [], _Numbered()
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = t.as_py()
                w = words(t)
                ids.append(i)
                sizes.append(len(t.encode()))
                rows.append(np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)))
                size += sizes[-1]
                if size >= block_bytes:
                    yield block(number, ids, sizes, rows, numbers)
                    number, size = number + 1, 0
                    ids, sizes, rows, numbers = [], [], [], _Numbered()
        if ids:
            yield block(number, ids, sizes, rows, numbers)
    return run


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, block_bytes: int = 24 << 20,
                 shards: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    1. Tasks turn their documents into blocks: the block's distinct
       pre-tokens, dealt to shards by hash, and each document's frequencies
       of them.  The blocks are written once, so every later step sees the
       same numbering even if a task runs again.
    2. A shard's distinct pre-tokens are encoded once each; every block gets
       its counts back as one array per shard.
    3. Each block adds frequency times count per document.  No ids are kept.

    A hot word costs one entry per block.  Memory: a task holds one block of
    ``block_bytes`` of text, or one shard's distinct pre-tokens; ``shards``
    follows the input (one for each 128 MB of text, at least 24).  Null text
    counts as empty, null and repeated ids keep their rows, other columns are
    ignored.  For tokenizers that drop white space.
    """
    shards = shards or max(24, -(-text_bytes(docs) // (128 << 20)))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = materialize(rows.mapInArrow(_blocks(block_bytes, shards), _BLOCK), "pretokens")

    def counted(pdf: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(tokenizer, spaced=False)
        lists = [zstandard.ZstdDecompressor().decompress(p).decode().split("\n") for p in pdf.payload]
        known: dict[str, int] = dict.fromkeys(w for x in lists for w in x)
        for w in known:
            known[w] = len(enc.encode(w)) // 4
        return pd.DataFrame({"block": pdf.block, "shard": pdf["shard"],
                             "payload": [_pack(np.fromiter(map(known.__getitem__, x), np.int32, len(x))) for x in lists]})

    counts = blocks.filter("shard >= 0").groupBy("shard").applyInPandas(counted, _BLOCK)

    def summed(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, null, sizes, indptr, delta, freq = _unpack(left.payload.iloc[0])
        per = [_unpack(p)[0] for p in right.sort_values("shard").payload]
        per = np.concatenate(per).astype(np.int64) if per else np.zeros(0, np.int64)
        first = np.zeros(len(delta) + 1, np.int64)
        np.cumsum(delta, out=first[1:])
        # indexes are deltas within a document, so each starts again from 0
        index = first[1:] - np.repeat(first[indptr[:-1]], np.diff(indptr))
        total = np.zeros(len(delta) + 1, np.int64)
        np.cumsum(per[index] * freq, out=total[1:])
        ids = pd.Series(ids, dtype="Int64").mask(null.astype(bool))
        return pd.DataFrame({"doc_id": ids, "n_bytes": sizes, "n_tokens": total[indptr[1:]] - total[indptr[:-1]]})

    out = (blocks.filter("shard < 0").groupBy("block").cogroup(counts.groupBy("block"))
           .applyInPandas(summed, "doc_id long, n_bytes long, n_tokens long"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
