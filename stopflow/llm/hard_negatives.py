"""Hard negatives for embedding anchors by rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopflow.session import materialize

from .common import shuffle_partitions

# One-bit codes are stacked: each codes what the ones before it leave over,
# rotated anew.  Anchors are rounded to PLANES bits so that popcounts give
# their products.
LEVELS, PLANES, SEED = 5, 8, 11
# Rounding of the double-precision estimates, far above what they can lose.
SLACK = 1e-9
# A block of rows or anchors has at most this many bytes of codes and vectors,
# and at most BLOCK rows; anchors are taken TILE at a time against it.
BLOCK, BLOCK_BYTES, TILE = 32_768, 32 << 20, 64
# Components of at most this size, and vectors of a norm below 2^30, keep
# scores well within a long.
LARGEST = 2**30


def _rotate(x: np.ndarray, level: int) -> np.ndarray:
    """Rows times a fixed orthogonal matrix: two rounds of random signs and a Walsh-Hadamard transform, padded to a power of two of at least 64."""
    width = max(64, 1 << (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), width))
    out[:, :x.shape[1]] = x
    rng = np.random.default_rng([SEED, level, width])
    for _ in range(2):
        out *= rng.choice([-1.0, 1.0], width)
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), width)
            half *= 2
        out /= np.sqrt(width)
    return out


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, LEVELS, words) of uint64, alignments (rows, LEVELS) and the norms of what the codes leave over.

    A code's vector has the signs of the rotated remainder, each 1 / sqrt(width).  Its
    alignment, the product of both, is stored, and the remainder loses that much of it.
    """
    rest = x
    codes = aligned = None
    for k in range(LEVELS):
        rest = _rotate(rest, k)
        width = rest.shape[1]
        if k == 0:
            codes, aligned = np.empty((len(x), LEVELS, width // 64), np.uint64), np.empty((len(x), LEVELS))
        positive = rest >= 0
        codes[:, k] = np.packbits(positive, axis=1, bitorder="little").view(np.uint64)
        aligned[:, k] = np.abs(rest).sum(1) / np.sqrt(width)
        rest -= np.where(positive, 1.0, -1.0) * (aligned[:, k:k + 1] / np.sqrt(width))
    return codes, aligned, np.sqrt((rest * rest).sum(1))


def _planes(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rotated anchors rounded to PLANES bits: bit planes (anchors, PLANES, words), lowest value, step and error."""
    low = r.min(1)
    step = np.maximum((r.max(1) - low) / (2**PLANES - 1), 1e-300)
    level = np.rint((r - low[:, None]) / step[:, None]).astype(np.uint8)
    lost = np.abs(r - (low[:, None] + step[:, None] * level)).sum(1)
    planes = np.stack([np.packbits((level >> b) & 1, axis=1, bitorder="little").view(np.uint64) for b in range(PLANES)], 1)
    return planes, low, step, lost / np.sqrt(r.shape[1])


def intervals(anchors: np.ndarray, codes: np.ndarray, aligned: np.ndarray, left: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of every anchor's inner product with every coded row.

    Popcounts of the codes against the anchors' bit planes estimate the
    products with the coded part of a row.  What is left over of a row is at
    most its norm times the anchor's, by Cauchy-Schwarz; the anchors'
    rounding is known.  So the bounds always hold.
    """
    width = codes.shape[2] * 64
    size = np.sqrt((anchors.astype(np.float64) ** 2).sum(1))
    estimate, r = np.zeros((len(anchors), len(codes))), anchors
    error = size[:, None] * (left + SLACK * norms)[None] + 1e-6
    for k in range(LEVELS):
        r = _rotate(r, k)
        planes, low, step, lost = _planes(r)
        code, weighted = codes[:, k], np.zeros((len(anchors), len(codes)), np.int32)
        for b in range(PLANES):
            for w in range(code.shape[1]):
                weighted += np.bitwise_count(planes[:, b, w][:, None] & code[None, :, w]).astype(np.int32) << b
        inside = low[:, None] * np.bitwise_count(code).sum(1, dtype=np.int64) + step[:, None] * weighted
        estimate += aligned[:, k] / np.sqrt(width) * (2 * inside - r.sum(1)[:, None])
        error += lost[:, None] * aligned[:, k]
    return estimate - error, estimate + error


def _vectors(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    """Integer vectors of one length from their bytes."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.int64).reshape(n, -1)


_CODED = "vec_id long, label string, anchor boolean, dim int, vector binary, codes binary, aligned binary, rest double"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of a batch's integer vectors, a slice of one length at a time."""
    for batch in batches:
        sizes = batch.column("dim").to_numpy()
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            for some in np.array_split(at, -(-len(at) * int(dim) // (1 << 19))):
                part = batch.take(pa.array(some))
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                x = flat.reshape(len(some), -1)
                codes, aligned, rest = encode(x)
                lists = [pa.array([row.tobytes() for row in m], pa.binary()) for m in (x, codes, aligned)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("vec_id", "label", "anchor", "dim")), *lists, pa.array(rest)],
                                                 names=["vec_id", "label", "anchor", "dim", "vector", "codes", "aligned", "rest"])


class _Block:
    """The rows of one block, in the order of vec_id."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        self.ids = table.column("vec_id").to_numpy()
        order = np.argsort(self.ids, kind="stable")
        self.ids = self.ids[order]
        self.labels = np.array(table.column("label").to_pylist(), object)[order]
        self.x = _vectors(table.column("vector"), n)[order]
        self.codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint64).reshape(n, LEVELS, -1)[order]
        self.aligned = np.frombuffer(b"".join(table.column("aligned").to_pylist()), np.float64).reshape(n, LEVELS)[order]
        self.rest = table.column("rest").to_numpy()[order]
        self.norms = np.sqrt((self.x.astype(np.float64) ** 2).sum(1))

    def bounds(self, anchors: np.ndarray, at: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        return intervals(anchors, self.codes[at], self.aligned[at], self.rest[at], self.norms[at])


def _best(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` highest scores, ties by place."""
    return np.lexsort((at, -scores))[:k]


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, -k)[-k] if len(values) >= k else -np.inf


def _same_label(k: int):
    """Of each anchor and block of rows, the ``k`` best rows of the anchor's label."""
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            block = _Block(rows)
            q, ids = _vectors(anchors.column("a_vector"), anchors.num_rows), anchors.column("a_vec_id").to_numpy()
            labels = np.array(anchors.column("a_label").to_pylist(), object)
            for label in sorted(set(labels.tolist())):
                own = np.flatnonzero(block.labels == label)
                mine = np.flatnonzero(labels == label)
                for some in np.array_split(mine, -(-len(mine) // TILE)) if len(own) else ():
                    low, high = block.bounds(q[some], own)
                    for j, a in enumerate(some):
                        other = block.ids[own] != ids[a]
                        at = own[other & (high[j] >= _kth(low[j][other], k))]
                        scores = block.x[at] @ q[a]
                        best = _best(scores, at, k)
                        out += [(int(ids[a]), int(block.ids[at[b]]), int(scores[b])) for b in best]
        cols = list(zip(*out, strict=True)) or [()] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["anchor_id", "other_id", "score"])
    return run


def _other_label(k: int, low_share: Fraction, high_share: Fraction):
    """Of each anchor, window of scores and block of rows, the ``k`` best rows of other labels in the window."""
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            block = _Block(rows)
            q, ids = _vectors(anchors.column("a_vector"), anchors.num_rows), anchors.column("a_vec_id").to_numpy()
            labels, goals = anchors.column("a_label").to_pylist(), anchors.column("goals").to_pylist()
            for some in np.array_split(np.arange(len(q)), -(-len(q) // TILE)):
                low, high = block.bounds(q[some])
                for j, a in enumerate(some):
                    windows = [(g, -(-low_share.numerator * g // low_share.denominator), high_share.numerator * g // high_share.denominator) for g in goals[a]]
                    windows = [w for w in windows if w[1] <= w[2]]
                    if not windows:
                        continue
                    near = np.flatnonzero((block.labels != labels[a]) & (block.ids != ids[a])
                                          & (high[j] >= min(w[1] for w in windows)) & (low[j] <= max(w[2] for w in windows)))
                    lo, hi = low[j][near], high[j][near]
                    for goal, least, most in windows:
                        sure = lo[(lo >= least) & (hi <= most)]
                        at = near[(hi >= least) & (lo <= most) & (hi >= _kth(sure, k))]
                        scores = block.x[at] @ q[a]
                        inside = (scores >= least) & (scores <= most)
                        at, scores = at[inside], scores[inside]
                        out += [(int(ids[a]), goal, int(block.ids[at[b]]), int(scores[b])) for b in _best(scores, at, k)]
        cols = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["anchor_id", "goal", "other_id", "score"])
    return run


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each key, numbered from 1; each block has sent at most ``k``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label (as text), dim and v (longs): floor(scale * x) of the rows that take part."""
    x = F.transform("embedding", lambda c: c.cast("double") * scale)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine)
    rows = rows.select("vec_id", "label", F.transform(x, lambda c: F.floor(c)).alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double"))
    rows = rows.filter(norm < float(LARGEST) ** 2)
    once = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return once.select("vec_id", "r.label", "r.v", F.size("r.v").alias("dim"))


def _blocks(n: int, most: int, least: int) -> int:
    """How many blocks: none larger than ``most`` by much, and enough for all tasks of a small table."""
    return max(1, -(-n // most), min(least, -(-n // 2048)))


def hard_negatives(vectors: DataFrame, every: int = 50, n_positives: int = 5, n_negatives: int = 3,
                   low: Fraction = Fraction(1, 2), high: Fraction = Fraction(95, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of ``vectors`` (vec_id, label, embedding).

    Components become floor(256 * x), and a score is the integer inner product
    of two rows; ties go by smaller vec_id.  Rows whose vec_id is divisible by
    ``every`` are anchors, and an anchor's positives its first ``n_positives``
    other rows of its label.  For each of those come the first ``n_negatives``
    rows of other labels whose score lies between ``low`` and ``high`` times
    the positive's.

    1. Vectors are rotated and coded by the signs of what is left over, one
       bit a dimension and level, with each code's alignment stored.
    2. Anchors, in blocks, meet all rows, in blocks.  Popcounts estimate the
       scores and Cauchy-Schwarz bounds what the codes leave over, so each
       score has an interval that always holds (see ``intervals``).
    3. Rows whose interval can't reach the anchor's best, or lies outside the
       window of scores, go; the others are scored in integers.  Each block
       sends its best few rows per anchor, and these are merged.

    The result is exact.  Every row meets every anchor once for positives and
    once for negatives, in bounded blocks, so a label that holds most rows
    splits like any other.  Rows with a null vec_id, label or vector, an empty
    vector, a null or non-finite component, a component of 2^30 / 256 or more
    or an integer norm of 2^30 or more take no part.  Of rows that share a
    vec_id the one with the smallest label, then vector, takes part.  Vectors
    of other lengths have no score with each other.  An empty table gives no
    rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors).withColumn("anchor", F.col("vec_id") % every == 0)
    coded = materialize(rows.select("vec_id", "label", "anchor", "dim", "v").mapInArrow(_coded, _CODED), "coded")
    counts = coded.agg(F.count("*").alias("n"), F.count_if("anchor").alias("a"), F.max("dim").alias("d")).first()
    most = max(64, min(BLOCK, BLOCK_BYTES // (24 * (counts.d or 1) + 1)))
    tasks = shuffle_partitions(spark)
    n_rows, n_anchors = _blocks(counts.n, most, tasks), _blocks(counts.a, most, 1)
    block = lambda n, key="vec_id": F.pmod(F.xxhash64(key), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    all_rows = coded.withColumn("r_block", block(n_rows)).withColumn("a_block", each(n_anchors)).groupBy("dim", "a_block", "r_block")

    def against(anchors: DataFrame):
        spread = anchors.withColumn("of", block(n_anchors, "a_vec_id")).withColumn("to", each(n_rows))
        return spread.groupBy("a_dim", "of", "to").cogroup(all_rows)

    # columns of their own, as both sides of a cogroup come from one table
    anchors = coded.filter("anchor").select(*(F.col(c).alias(f"a_{c}") for c in ("vec_id", "label", "dim", "vector")))
    met = against(anchors).applyInArrow(_same_label(n_positives), "anchor_id long, other_id long, score long")
    positives = _first(met, ["anchor_id"], n_positives).select("anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    positives = materialize(positives, "positives")
    goals = positives.groupBy(F.col("anchor_id").alias("g_id")).agg(F.sort_array(F.collect_set("positive_score")).alias("goals"))
    wanted = anchors.join(goals, F.col("a_vec_id") == F.col("g_id")).drop("g_id")
    met = against(wanted).applyInArrow(_other_label(n_negatives, low, high), "anchor_id long, goal long, other_id long, score long")
    negatives = _first(met, ["anchor_id", "goal"], n_negatives).select(
        F.col("anchor_id").alias("n_anchor"), "goal", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (positives.join(negatives, (F.col("anchor_id") == F.col("n_anchor")) & (F.col("positive_score") == F.col("goal")))
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """``vectors`` with label (label + 1) % 10 where vec_id is divisible by 7."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY m.score DESC, m.other_id))::INT AS rank,
       m.other_id AS negative_id, p.positive_score, m.score AS negative_score
FROM positives p JOIN met m ON p.anchor_id = m.anchor_id AND NOT m.same
WHERE 50 * p.positive_score <= 100 * m.score AND 100 * m.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY m.score DESC, m.other_id) <= 3
"""
