"""Near-duplicate embeddings by an inverted multi-index."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.session import materialize

from .common import connected_components

# Bounds: vectors that codebooks are fitted on, queries that the traversal is
# calibrated with, cells a vector visits at least and at most, vectors on
# either side of a block.
FIT_SAMPLE, QUERIES, LEAST_CELLS, MOST_CELLS, BLOCK = 20_000, 2048, 4, 1024, 1024
# Below so many queries with links, planted partners count too.
ENOUGH = 300

log = logging.getLogger(__name__)

_CODED = "k long, label long, home int, probes array<int>, vec binary, size long"


class MultiIndex:
    """Codebooks of unit vectors' halves; their product is the grid of cells.

    ``visits`` is how many cells, nearest first, a vector looks into.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray, threshold: float, visits: int = 1):
        self.books, self.threshold, self.visits = (first, second), threshold, visits
        self.dim = first.shape[1] + second.shape[1]
        self.gaps = [np.sqrt(np.maximum(_distances(b, b), 1e-30)) for b in self.books]

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        h = self.books[0].shape[1]
        return [_distances(x[:, :h], self.books[0]), _distances(x[:, h:], self.books[1])]

    def home(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.distances(x)
        return d1.argmin(1) * len(self.books[1]) + d2.argmin(1)

    def traverse(self, x: np.ndarray, visits: int, prune: bool) -> tuple[np.ndarray, np.ndarray]:
        """The nearest cells of each vector in order, and their distances.

        Multi-sequence traversal: with each half's codewords in order of
        distance, the cell of the a-th and b-th comes after all cells of no
        later ones, so only those with (a + 1)(b + 1) <= visits can be among
        the first ``visits``.  ``prune`` puts -1 for cells that can't hold a
        vector within the link distance: between the nearest codeword and
        another lies a border that far away at least.
        """
        d1, d2 = self.distances(x)
        n1, n2 = min(d1.shape[1], visits), min(d2.shape[1], visits)
        o1, o2 = np.argsort(d1, 1, kind="stable")[:, :n1], np.argsort(d2, 1, kind="stable")[:, :n2]
        s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        grid = [(a, b) for a in range(n1) for b in range(min(n2, visits // (a + 1)))]
        a, b = np.array(grid).T
        far = s1[:, a] + s2[:, b]
        take = np.argsort(far, 1, kind="stable")[:, :visits]
        a, b = a[take], b[take]
        cell = np.take_along_axis(o1, a, 1) * len(self.books[1]) + np.take_along_axis(o2, b, 1)
        if prune:
            low = 0
            for s, o, g, at in ((s1, o1, self.gaps[0], a), (s2, o2, self.gaps[1], b)):
                border = np.maximum(s - s[:, :1], 0) / (2 * g[o[:, :1], o])
                border[:, 0] = 0
                low = low + np.take_along_axis(border, at, 1) ** 2
            cell = np.where(low > 2 - 2 * self.threshold + 1e-9, -1, cell)
        return cell, np.take_along_axis(far, take, 1)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1), 0)


def _codebook(x: np.ndarray, size: int, seed: int, rounds: int = 20) -> np.ndarray:
    """Lloyd's k-means on a bounded sample."""
    pick = np.random.default_rng(seed).permutation(len(x))
    book = np.unique(x[pick[:4 * size]], axis=0)
    book = book[np.random.default_rng(seed).permutation(len(book))[:size]]
    for _ in range(rounds):
        near = _distances(x, book).argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=len(book))[:, None]
        book = np.where(count > 0, sums / np.maximum(count, 1), book)
    return book


def _unit(raw: list[bytes] | pd.Series, kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # else squares of very large or small components leave doubles
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _ranks(index: MultiIndex, x: np.ndarray, cells: np.ndarray, most: int) -> np.ndarray:
    """The rank of one cell in each vector's order; ``most`` if it isn't among the first ``most``."""
    out = np.full(len(x), most)
    for s in range(0, len(x), 128):
        here = index.traverse(x[s:s + 128], most, prune=False)[0] == cells[s:s + 128, None]
        out[s:s + 128] = np.where(here.any(1), here.argmax(1), most)
    return out


def _planted(index: MultiIndex, q: np.ndarray, most: int) -> dict[str, np.ndarray]:
    """Shares of planted links reached by visiting 1, 2, ... ``most`` cells from either side.

    Every query gets partners at the threshold cosine, the farthest that
    links: one in a random direction and one towards another query, as real
    vectors don't differ in all directions alike.
    """
    rng = np.random.default_rng(5)
    out = {}
    for name, other in (("random", rng.normal(size=q.shape)), ("towards others", q[rng.permutation(len(q))])):
        away = other - (other * q).sum(1, keepdims=True) * q
        length = np.sqrt((away * away).sum(1))
        some = length > 1e-6
        if some.any():
            x = q[some]
            partner = index.threshold * x + math.sqrt(max(0, 1 - index.threshold ** 2)) * away[some] / length[some, None]
            rank = np.minimum(_ranks(index, x, index.home(partner), most), _ranks(index, partner, index.home(x), most))
            out[name] = np.bincount(rank, minlength=most + 1)[:most].cumsum() / len(x)
    return out


def _calibrated(vectors: DataFrame, index: MultiIndex, queries: list, recall: float, kind: str) -> tuple[int, dict[str, float]]:
    """How many cells to visit for ``recall``, and what is reached: a fixed set of queries is compared with all vectors.

    Each task returns how many true links of a query lie in the cell of each
    rank, at most QUERIES times MOST_CELLS + 1 numbers.  ``recall`` is to be
    the mean over the queries that have links, where one large group counts no
    more than a pair, and the share of all their links, where it does.  If
    fewer than ENOUGH queries have links, it is also to be the share of
    planted ones (see ``_planted``), so it never rests on a handful.
    """
    q = _unit([r.vec for r in queries], kind)
    own, labels = np.array([r.k for r in queries]), np.array([r.label for r in queries])
    width = len(index.books[0]) * len(index.books[1])
    most = min(MOST_CELLS, width)
    cells, _ = index.traverse(q, most, prune=False)
    at = (np.arange(len(q))[:, None] * width + cells).ravel()
    order = np.argsort(at)
    at, ranks = at[order], np.tile(np.arange(most), len(q))[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(q) * (most + 1), np.int64)
        for b in batches:
            for start in range(0, b.num_rows, 2048):
                s = b.slice(start, 2048)
                x = _unit(s.column(2).to_pylist(), kind)
                near = (q @ x.T >= index.threshold) & (labels[:, None] == s.column(1).to_numpy()) & (own[:, None] != s.column(0).to_numpy())
                i, j = np.nonzero(near)
                key = i * width + index.home(x)[j]
                found = np.minimum(np.searchsorted(at, key), len(at) - 1)
                rank = np.where(at[found] == key, ranks[found], most)
                np.add.at(count, i * (most + 1) + rank, 1)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(count[some], pa.int64())], names=["at", "n"])

    found = (vectors.filter(F.octet_length("vec") == index.dim * np.dtype(kind).itemsize).select("k", "label", "vec")
             .mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect())
    table = np.zeros((len(q), most + 1))
    for r in found:
        table[r["at"] // (most + 1), r["at"] % (most + 1)] = r.n
    table = table[table.sum(1) > 0]
    shares = {}
    if len(table):
        shares["queries"] = (table.cumsum(1) / table.sum(1, keepdims=True)).mean(0)[:most]
        shares["links"] = (table.sum(0).cumsum() / table.sum())[:most]
    if len(table) < ENOUGH:
        shares |= _planted(index, q, most)
    least = min(LEAST_CELLS, most)
    if not shares:
        return least, {}
    enough = np.min(list(shares.values()), 0) >= recall - 1e-9
    visits = max(least, int(np.argmax(enough)) + 1) if enough.any() else most
    reached = {name: float(share[visits - 1]) for name, share in shares.items()}
    log.info("%d of %d cells, %d of %d queries with links, reached: %s", visits, width, len(table), len(q), reached)
    return visits, reached


def _coded(index: MultiIndex | None, kind: str):
    """Adds each vector's cell and the cells it visits; other lengths than the index's have a cell of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                s = b.slice(at, 4096)
                raw = s.column(2).to_pylist()
                dims = np.array([len(r) for r in raw]) // np.dtype(kind).itemsize
                home, probes = -dims, [[-int(d)] for d in dims]
                own = np.flatnonzero(dims == index.dim) if index else []
                if len(own):
                    x = _unit([raw[i] for i in own], kind)
                    home[own] = index.home(x)
                    cells, _ = index.traverse(x, index.visits, prune=True)
                    for i, c in zip(own, cells, strict=True):
                        probes[i] = sorted({int(home[i]), *c[c >= 0].tolist()})
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(home, pa.int32()), pa.array(probes, pa.list_(pa.int32())),
                                                  s.column(2), s.column(3)], names=["k", "label", "home", "probes", "vec", "size"])
    return run


def _block(threshold: float, kind: str):
    """Links between a block's visitors and its cell's vectors: counts by vector, and edges that span each group."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        here = pdf[pdf.resident]
        come = pdf[~pdf.resident]
        empty = pd.DataFrame({"u": pd.Series(dtype="int64"), "v": pd.Series(dtype="Int64"), "n": pd.Series(dtype="int64")})
        if not len(here) or not len(come):
            return empty
        cell = int(key[1])
        i, j = np.nonzero(_unit(come.vec.tolist(), kind) @ _unit(here.vec.tolist(), kind).T >= threshold)
        ck, hk, home = come.k.to_numpy(), here.k.to_numpy(), come.home.to_numpy()
        inside = home[i] == cell
        # Of two vectors of this cell each visits the other; of two cells that
        # visit each other, the pair counts in the one with the smaller number.
        keep = np.where(inside, ck[i] < hk[j], home[i] > cell)
        back = {x: set(p) for x, p in zip(hk, here.probes, strict=True)}
        for t in np.flatnonzero(~inside & ~keep):
            keep[t] = int(home[i[t]]) not in back[hk[j[t]]]
        i, j = i[keep], j[keep]
        if not len(i):
            return empty
        ids, at = np.unique(np.concatenate([ck[i], hk[j]]), return_inverse=True)
        a, b = at[:len(i)], at[len(i):]
        n = np.bincount(a, here["size"].to_numpy()[j], len(ids)) + np.bincount(b, come["size"].to_numpy()[i], len(ids))
        low = np.arange(len(ids))
        while True:
            new = low.copy()
            np.minimum.at(new, a, low[b])
            np.minimum.at(new, b, low[a])
            new = new[new]
            if (new == low).all():
                break
            low = new
        off = np.flatnonzero(low != np.arange(len(ids)))
        return pd.DataFrame({"u": np.concatenate([ids, ids[off]]), "v": pd.array([None] * len(ids) + ids[low[off]].tolist(), "Int64"),
                             "n": np.concatenate([n.astype(np.int64), np.zeros(len(off), np.int64)])})
    return run


def embedding_duplicates(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.99, cell_size: int = 128) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Vectors link when their labels are equal and not null and their cosine, in
    double precision, is at least ``threshold``.  Vectors that are null, zero,
    or hold null or non-finite components link with nothing, nor do vectors of
    different lengths, without a label or without an id.

    1. Equal (label, embedding) rows become one vector with a size.
    2. Two codebooks, for the halves of the unit vectors, are fitted on at
       most FIT_SAMPLE vectors (smallest hashes) of the most frequent length;
       their size gives cells of about ``cell_size`` vectors per label.
    3. QUERIES vectors are compared with all vectors; from the ranks of the
       cells that hold their links follows how many cells, nearest first,
       must be visited for ``recall``; planted links count too where few
       queries have any.  If MOST_CELLS don't reach it, smaller codebooks make
       larger cells, until MOST_CELLS are all; the reached recall is logged.
       All rows are indexed.
    4. Every vector visits its nearest cells, but those that provably hold no
       link.  Visitors and inhabitants of a cell meet in blocks of about BLOCK
       by BLOCK vectors, whatever the cell's size, and pairs are verified by
       matrix products.  Two rules make every pair count in one block only,
       so blocks return sums by vector and spanning edges, not pairs.

    Pairs in cells that neither vector visits are missed; README has measured
    recall.  Other columns are ignored; an empty table gives an empty one;
    repeated rows count as other vectors.  A component's id is its smallest
    vec_id.
    """
    spark = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    value = F.col("embedding") if kind == "<f4" else F.col("embedding").cast("array<double>")
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), value.alias("e"))
    valid = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("e").isNotNull() & ~bad & F.exists("e", lambda x: x != 0), F.lit(False))
    rows = rows.select("vec_id", F.when(valid, F.xxhash64("label", "e")).alias("k"), "label", "e")
    groups = rows.filter("k is not null").groupBy("k", "label", "e").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = b.column(2)
            x, o = e.values.to_numpy(zero_copy_only=False).astype(kind), e.offsets.to_numpy()
            raw = [x[s:t].tobytes() for s, t in zip(o[:-1], o[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary()), b.column(3), b.column(4)],
                                             names=["k", "label", "vec", "size", "least"])

    groups = materialize(groups.select("k", "label", "e", "size", "least").mapInArrow(
        packed, "k long, label long, vec binary, size long, least long"), "vectors")
    shape = groups.agg(F.mode(F.octet_length("vec")).alias("bytes"), F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")).first()
    index = None
    if shape.n and shape.bytes >= 2 * np.dtype(kind).itemsize:
        alike = groups.filter(F.octet_length("vec") == shape.bytes).select("k", "label", "vec")
        sample = alike.orderBy(F.xxhash64("k"), "k").limit(FIT_SAMPLE).collect()
        x = _unit([r.vec for r in sample], kind)
        size = max(4, min(4096, math.ceil(math.sqrt(shape.n / max(1, shape.labels) / cell_size))))
        half = x.shape[1] // 2
        fit = x[QUERIES:] if len(x) >= 4 * QUERIES else x  # codewords that were fitted to the queries would lie too near to them
        while True:
            index = MultiIndex(_codebook(fit[:, :half], size, 1), _codebook(fit[:, half:], size, 2), threshold)
            index.visits, reached = _calibrated(groups, index, sample[:QUERIES], recall, kind)
            if size ** 2 <= MOST_CELLS or min(reached.values(), default=1) >= recall - 1e-9:
                break
            size //= 2
            log.info("recall not reached within %d cells, codebooks of %d next", MOST_CELLS, size)

    coded = materialize(groups.select("k", "label", "vec", "size").mapInArrow(_coded(index, kind), _CODED), "coded")
    visits = coded.select("k", "label", "home", F.explode("probes").alias("cell"), "vec", "size")
    # only cells with more than a block on either side, so at most visits / BLOCK of them
    crowded = (visits.groupBy("label", "cell").agg(F.count("*").alias("come"), F.count(F.when(F.col("home") == F.col("cell"), 1)).alias("here"))
               .filter(F.col("come") > BLOCK).select(F.col("label").alias("c_label"), F.col("cell").alias("c_cell"),
                                                     F.ceil(F.col("come") / BLOCK).cast("int").alias("ps"),
                                                     F.greatest(F.ceil(F.col("here") / BLOCK), F.lit(1)).cast("int").alias("rs")))
    crowded = materialize(crowded, "crowded")
    by = lambda cell: (F.col("label") == F.col("c_label")) & (F.col(cell) == F.col("c_cell"))
    ps, rs = F.coalesce("ps", F.lit(1)), F.coalesce("rs", F.lit(1))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    come = (visits.join(crowded, by("cell"), "left").withColumn("sp", F.pmod(F.xxhash64("k"), ps).cast("int")).withColumn("sr", all_of(rs))
            .select("label", "cell", "sr", "sp", F.lit(False).alias("resident"), "k", "home", F.lit(None).cast("array<int>").alias("probes"), "vec", "size"))
    here = (coded.join(crowded, by("home"), "left").withColumn("sr", F.pmod(F.xxhash64("k"), rs).cast("int")).withColumn("sp", all_of(ps))
            .select("label", F.col("home").alias("cell"), "sr", "sp", F.lit(True).alias("resident"), "k", "home", "probes", "vec", "size"))
    met = materialize(come.unionByName(here).groupBy("label", "cell", "sr", "sp").applyInPandas(_block(threshold, kind), "u long, v long, n long"), "links")

    counts = met.filter("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    component = connected_components(groups.select(F.col("k").alias("id")), met.filter("v is not null").select("u", "v"))
    named = groups.join(component, F.col("k") == F.col("id")).select("k", "size", "least", "component_id")
    smallest = named.groupBy("component_id").agg(F.min("least").alias("smallest"))
    named = materialize(named.join(smallest, "component_id").join(counts, F.col("k") == F.col("u"), "left")
                        .select(F.col("k").alias("of"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "smallest"), "named")
    out = rows.select("vec_id", "k").join(named, F.col("k") == F.col("of"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("smallest", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


# All pairs: what the index finds when it misses none.
EMBEDDING_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM valid a JOIN valid b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u),
reached(vec_id, top) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.v FROM reached r JOIN links l ON r.top = l.u)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, r.component_id, v.vec_id = r.component_id AS kept
FROM embeddings v LEFT JOIN counts c ON v.vec_id = c.u
JOIN (SELECT vec_id, min(top) AS component_id FROM reached GROUP BY vec_id) r ON v.vec_id = r.vec_id
"""
