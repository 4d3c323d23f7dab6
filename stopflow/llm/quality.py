"""Quality classification by the perplexity of an n-gram model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.session import materialize

from .common import landed


# The model is over characters (UTF-16 code units): four units fill a 64-bit
# key, earliest first, and START stands before a text.
ORDER, START = 4, 0xFFFF
_CHUNK = 1 << 20
# Tables of a row per language are broadcast if at most so many rows are
# expected; ids to drop if at most so many are counted.
MOST_LANGUAGES, MOST_BROADCAST = 10_000, 1_000_000


def grams(text: str) -> np.ndarray:
    """A key of each unit and the three before it, in order."""
    raw = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
    u = np.concatenate([np.full(ORDER - 1, START, np.uint16), raw]).astype(np.uint64)
    n = len(raw)
    return (u[:n] << np.uint64(48) | u[1:n + 1] << np.uint64(32) | u[2:n + 2] << np.uint64(16) | u[3:]).view(np.int64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (block, doc_id, x, lang, text) as compressed record batches, one per block and input batch."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for b in batches:
        block = b.column(0).to_numpy()
        keys, payloads = np.unique(block), []
        rest = b.select(["doc_id", "x", "lang", "text"])
        for k in keys:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=options) as out:
                out.write_batch(rest.take(pa.array(np.flatnonzero(block == k))))
            payloads.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(payloads, pa.binary())], names=["block", "payload"])


def _documents(blobs: pa.Table) -> Iterator[tuple[int | None, int, str, str]]:
    for p in blobs.column("payload"):
        for b in pa.ipc.open_stream(p.as_py()):
            for row in zip(*(b.column(i) for i in range(4)), strict=True):
                yield tuple(x.as_py() for x in row)


class _Counter:
    """Distinct keys and their counts, merged a bounded chunk at a time."""

    def __init__(self):
        self.waiting, self.size, self.keys, self.counts = [], 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.size += len(keys)
        if self.size >= _CHUNK:
            self.merge()

    def merge(self) -> None:
        new, n = np.unique(np.concatenate([*self.waiting, np.zeros(0, np.int64)]), return_counts=True)
        keys, at = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        self.counts = np.bincount(at, np.concatenate([self.counts, n]), len(keys)).astype(np.int64)
        self.keys, self.waiting, self.size = keys, [], 0


_GRAM = "block int, lang string, g long, n long"


def _counted(blobs: pa.Table, trusted: pa.Table) -> pa.Table:
    """The block's distinct grams by language, and how often each stands in its trusted texts."""
    ids = set(trusted.column("doc_id").to_pylist())
    every, good = {}, {}
    for doc_id, _, lang, text in _documents(blobs):
        keys = grams(text)
        every.setdefault(lang, _Counter()).add(keys)
        if doc_id in ids:
            good.setdefault(lang, _Counter()).add(keys)
    parts = []
    for lang, c in every.items():
        c.merge()
        n = np.zeros(len(c.keys), np.int64)
        if lang in good:
            good[lang].merge()
            n[np.searchsorted(c.keys, good[lang].keys)] = good[lang].counts
        parts.append(pa.table({"block": pa.array(np.full(len(n), blobs.column("block")[0].as_py()), pa.int32()),
                               "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int64))), "g": c.keys, "n": n}))
    empty = pa.table({"block": pa.array([], pa.int32()), "lang": pa.array([], pa.string()), "g": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    return pa.concat_tables(parts) if parts else empty


_SCORE = "doc_id long, x long, lang string, units long, nll double"


def _scored(blobs: pa.Table, answers: pa.Table) -> pa.Table:
    """Each document's units and the sum of their negative log probabilities."""
    lang, key, value = (answers.column(c).combine_chunks() for c in ("lang", "g", "logp"))
    tables = {}
    for name in lang.unique().to_pylist():
        mine = pa.compute.equal(lang, name)
        k, v = key.filter(mine).to_numpy(), value.filter(mine).to_numpy()
        order = np.argsort(k)
        tables[name] = k[order], v[order]
    rows = []
    for doc_id, x, name, text in _documents(blobs):
        keys = np.sort(grams(text))
        nll = 0.0
        if len(keys):
            k, v = tables[name]
            nll = -float(v[np.searchsorted(k, keys)].sum())
        rows.append((doc_id, x, name, len(keys), nll))
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64()), strict=True)],
                    names=["doc_id", "x", "lang", "units", "nll"])


def _low(g: Column | str, units: int) -> Column:
    """The last ``units`` units of a key."""
    g = F.col(g) if isinstance(g, str) else g
    return g if units == ORDER else g.bitwiseAND(F.lit((1 << 16 * units) - 1))


def _discount(a: Column, suffix: str = "") -> Column:
    return F.when(a == 1, F.col(f"d1{suffix}")).when(a == 2, F.col(f"d2{suffix}")).otherwise(F.col(f"d3{suffix}"))


def _by_language(rows: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(rows) if few else rows


def kneser_ney(counts: DataFrame, few: bool) -> list[tuple[DataFrame, DataFrame]]:
    """Interpolated modified Kneser-Ney tables from (lang, g, a): counts of the highest order's grams.

    For orders 1 to ORDER: (lang, g, own) with the discounted share of a gram
    in its context, and (lang, context, rest) with the share left to the next
    lower order.  Lower orders count the distinct units before a gram.  Three
    discounts per language and order come from the numbers of grams that occur
    once to four times; where these are missing, 0.5, 1 and 1.5 stand in.
    Each table is written before the next is made from it, so plans stay small.
    """
    levels = [counts]
    for k in range(ORDER - 1, 0, -1):
        lower = levels[-1].select("lang", _low("g", k).alias("g")).groupBy("lang", "g").agg(F.count("*").alias("a"))
        levels.append(landed(lower, f"counts-{k}"))
    tables = []
    for k, a in enumerate(reversed(levels), 1):
        n = [F.count(F.when(F.col("a") == i, 1)) for i in range(1, 5)]
        of = a.groupBy("lang").agg(*(x.alias(f"n{i + 1}") for i, x in enumerate(n)))
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        whole = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0)
        each = [F.when(whole, F.greatest(F.lit(i / 10), F.least(F.lit(float(i)), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))))
                .otherwise(F.lit(i / 2)).alias(f"d{i}") for i in (1, 2, 3)]
        of = of.select(F.col("lang").alias("dl"), *each)
        a = a.join(_by_language(of, few), F.col("lang").eqNullSafe(F.col("dl"))).drop("dl")
        a = a.withColumns({"context": F.shiftrightunsigned("g", 16), "d": _discount(F.col("a"))})
        a = landed(a, f"discounts-{k}")
        sums = landed(a.groupBy("lang", "context").agg(F.sum("a").alias("all"), (F.sum("d") / F.sum("a")).alias("rest")), f"contexts-{k}")
        own = (a.join(sums.select(F.col("lang").alias("sl"), F.col("context").alias("sc"), "all"),
                      F.col("lang").eqNullSafe(F.col("sl")) & (F.col("context") == F.col("sc")))
               .select("lang", "g", (F.greatest(F.col("a") - F.col("d"), F.lit(0.0)) / F.col("all")).alias("own")))
        tables.append((landed(own, f"grams-{k}"), sums.select("lang", "context", "rest")))
    return tables


def log_probabilities(wanted: DataFrame, tables: list[tuple[DataFrame, DataFrame]], few: bool) -> DataFrame:
    """(lang, g, logp) of the distinct grams (lang, g) by joins with each order's tables.

    The lowest order shares its rest among the units seen and one unseen;
    languages without trusted text give every unit the same probability.
    """
    lower = None
    for k, (own, rest) in enumerate(tables, 1):
        keys = wanted.select("lang", _low("g", k).alias("g")).distinct()
        own = own.select(F.col("lang").alias("ol"), F.col("g").alias("og"), "own")
        rest = rest.select(F.col("lang").alias("rl"), F.col("context").alias("rc"), "rest")
        at = keys.withColumn("context", F.shiftrightunsigned("g", 16))
        at = at.join(own, F.col("lang").eqNullSafe(F.col("ol")) & (F.col("g") == F.col("og")), "left")
        at = at.join(rest, F.col("lang").eqNullSafe(F.col("rl")) & (F.col("context") == F.col("rc")), "left")
        if lower is None:
            seen = own.groupBy(F.col("ol").alias("vl")).agg((1 / (F.count("*") + 1)).alias("even"))
            at = at.join(_by_language(seen, few), F.col("lang").eqNullSafe(F.col("vl")), "left")
            below = F.coalesce("even", F.lit(2.0 ** -16))
        else:
            at = at.join(lower.select(F.col("lang").alias("pl"), F.col("g").alias("pg"), F.col("p").alias("pp")),
                         F.col("lang").eqNullSafe(F.col("pl")) & (_low("g", k - 1) == F.col("pg")))
            below = F.col("pp")
        lower = landed(at.select("lang", "g", (F.coalesce("own", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * below).alias("p")), f"probabilities-{k}")
    return lower.select("lang", "g", F.log("p").alias("logp"))


def perplexities(docs: DataFrame, trusted: DataFrame, block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, x, lang, units, nll for every row of ``docs`` (doc_id, lang, text); ``trusted`` has doc_ids.

    ``x`` is xxhash64 of the text, ``units`` the text's length in UTF-16 code
    units and ``nll`` the sum of their negative log probabilities, given the
    three units before, in the model of the trusted texts of the same
    language.  A null language is the language "", a null text is empty.

    Documents are dealt to blocks of about ``block_bytes`` of text by a hash
    of doc_id, as compressed batches.  A block counts its grams and those of
    its trusted texts; the counts are joined, sharded by (language, gram),
    into the model and with the grams that the blocks hold, and each block
    gets the log probabilities of its own grams back.  So texts never meet
    the whole model; what moves is each block's distinct grams, which grow
    with the input, and twice the compressed texts, to count and to score.
    Counts and probabilities are written, so the second pass starts from them
    and the first one's shuffle files are gone by then.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.approx_count_distinct("lang").alias("langs")).first()
    blocks, few = max(32, -(-(size.bytes or 0) // block_bytes)), size.langs < MOST_LANGUAGES
    block = lambda key: F.pmod(key, F.lit(blocks)).cast("int").alias("block")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("x"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.when(F.col("doc_id").isNull(), F.col("x")).otherwise(F.xxhash64("doc_id"))
    blobs = rows.select(block(key), "doc_id", "x", "lang", "text").mapInArrow(_packed, "block int, payload binary")
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    held = landed(blobs.groupBy("block").cogroup(ids.select(block(F.xxhash64("doc_id")), "doc_id").groupBy("block"))
                  .applyInArrow(_counted, _GRAM), "grams")
    totals = landed(held.groupBy("lang", "g").agg(F.sum("n").alias("a")), "counts")
    logp = log_probabilities(totals.select("lang", "g"), kneser_ney(totals.filter("a > 0"), few), few)
    answers = (held.join(logp.select(F.col("lang").alias("al"), F.col("g").alias("ag"), "logp"), (F.col("lang") == F.col("al")) & (F.col("g") == F.col("ag")))
               .select("block", "lang", "g", "logp"))
    return blobs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored, _SCORE)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the documents labelled as of good quality and not as toxic."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    return labels.filter((F.col("quality") == 1) & (toxic == 0)).select("doc_id")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, slack: float = 0.25, prior: int = 100) -> DataFrame:
    """doc_id, x, lang, units, perplexity, score, threshold, keep for every row of ``docs``.

    Of the trusted documents (see ``trusted_ids``), the half with even hashes
    of their ids trains the model and the other half, unseen like any other
    document, sets the thresholds.

    The score is the mean negative log probability of a text's units and of
    ``prior`` units at the median of the language's unseen trusted documents,
    so that a short text needs more to stand out.  A document stays unless its
    score is above its language's threshold: the ``quantile`` of the scores of
    that language's unseen trusted documents, plus ``slack`` times its
    distance from their median.  Languages without any keep all documents.

    Every row gets a result: null texts count as empty (perplexity 1), null
    languages as "", rows that repeat an id are scored each on its own text
    but are all trusted if the id is.  Other columns are ignored.
    """
    trusted = trusted_ids(labels)
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(2))
    scores = landed(perplexities(docs, trusted.filter(half == 0)), "perplexities")
    ids = trusted.filter(half == 1).select(F.col("doc_id").cast("long").alias("t")).distinct()
    good = materialize(scores.filter("units > 0").join(ids, F.col("doc_id") == F.col("t"), "left_semi").select("lang", "units", "nll"), "unseen")
    few = scores.agg(F.approx_count_distinct("lang").alias("n")).first().n < MOST_LANGUAGES
    middle = good.groupBy(F.col("lang").alias("ml")).agg(F.percentile_approx(F.col("nll") / F.col("units"), 0.5, 10_000).alias("middle"))
    score = (F.col("nll") + prior * F.col("middle")) / (F.col("units") + prior)
    top = (good.join(_by_language(middle, few), F.col("lang") == F.col("ml")).groupBy("ml")
           .agg(F.first("middle").alias("middle"), F.percentile_approx(score, quantile, 10_000).alias("top")))
    top = top.select("ml", "middle", (F.col("top") + slack * (F.col("top") - F.col("middle"))).alias("threshold"))
    top = _by_language(materialize(top, "thresholds"), few)
    return (scores.join(top, F.col("lang") == F.col("ml"), "left").withColumn("score", score)
            .select("doc_id", "x", "lang", "units", F.exp(F.col("nll") / F.greatest("units", F.lit(1))).alias("perplexity"), "score", "threshold",
                    F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True)).alias("keep")))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, unchanged.

    Rows are found by (doc_id, hash of the text).  Few rejected ones are
    broadcast after counting them, more are joined by a shuffle.
    """
    bad = classify(docs, labels, **options).filter(~F.col("keep")).select(F.col("doc_id").alias("bad_id"), F.col("x").alias("bad_x")).distinct()
    bad = materialize(bad, "rejected")
    if bad.count() <= MOST_BROADCAST:
        bad = F.broadcast(bad)
    return docs.alias("d").join(bad.alias("b"), (F.xxhash64("d.text") == F.col("b.bad_x"))
                                & F.col("d.doc_id").cast("long").eqNullSafe(F.col("b.bad_id")), "left_anti")
