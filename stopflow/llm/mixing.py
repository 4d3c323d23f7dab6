"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.session import materialize

from .common import carried, restored

# A rate is met by draws of at most this mean each, so that exp(-mean) stays
# well within doubles; the counts of independent draws add up.
DRAW_MEAN = 64.0
# Source tables of at most so many rows (under 2 KB each) are broadcast.
MOST_BROADCAST = 20_000


def hash_uniform(*parts: Column | str) -> Column:
    """A double in [0, 1) from the first 52 bits of an MD5 of the parts."""
    return hash52(*parts).cast("double") / F.lit(float(2**52))


def hash52(*parts: Column | str) -> Column:
    digest = F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """source, n_docs, size, rate: the mean number of copies that meets each source's weight.

    Size is in code points.  The mixture has ``epochs`` times the input's
    size; a source's share of it is its weight over the sum of the weights of
    the sources present.  Without ``weights`` all sources weigh the same;
    with them, unlisted sources weigh 0, and if all that are present do, every
    source with text has rate 0.  A negative weight is an error.  A null
    source is a source of its own (weight key None).  Sources without any
    text keep ``epochs`` copies.
    """
    if any(w < 0 for w in (weights or {}).values()):
        raise ValueError(f"negative weights: {weights}")
    by = docs.groupBy("source").agg(F.count("*").alias("n_docs"),
                                    F.sum(F.coalesce(F.char_length("text"), F.lit(0))).cast("long").alias("size"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    by = materialize(by.withColumn("weight", weight), "sources")
    of_all = lambda c: by.agg(F.sum(c)).scalar()
    share = F.try_divide(F.col("weight"), of_all("weight")) * of_all("size") * F.lit(float(epochs))
    rate = F.when(F.col("size") > 0, share / F.col("size")).otherwise(F.lit(float(epochs)))
    return by.select("source", "n_docs", "size", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def _cdf(mean: Column) -> Column:
    """P(X <= k) of a Poisson distribution for k = 0, 1, ... until nothing is left in doubles."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def add(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.array_append(acc["c"], F.element_at(acc["c"], -1) + p).alias("c"))
    return F.aggregate(F.sequence(F.lit(1), last), start, add, lambda acc: acc["c"])


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0,
                seed: int = 0) -> DataFrame:
    """``docs`` replicated to the target weights and shuffled: its columns, then copy and shuffle_key.

    The number of copies inverts a Poisson distribution with the source's
    rate at a uniform number hashed from (seed, doc_id): the same input gives
    the same mixture on any cluster, and weights are met in expectation.
    Rows come out in the order of ``shuffle_key``, a hash of (seed, doc_id,
    copy), over all partitions; ties by doc_id and copy.

    Rows that share a doc_id draw the same count; rows without one are told
    apart by a hash of their text.  Null texts count 0 code points.  Input
    columns named copy or shuffle_key are replaced.  An empty table gives an
    empty one, as do weights of 0 for all sources present that have text.

    The join on source broadcasts the table of sources after counting its
    rows; a longer one is joined by AQE's choice, which splits hot sources.
    Only the global sort moves texts.
    """
    names = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce(F.xxhash64("text").cast("string"), F.lit(""))))
    rates = source_rates(docs, weights, epochs)
    draws = F.greatest(F.ceil(F.col("rate") / DRAW_MEAN), F.lit(1)).cast("int")
    rates = rates.select(F.col("source").alias("_source"), draws.alias("_draws"), (F.col("rate") / draws).alias("_mean"))
    rates = materialize(rates.select("_source", "_draws", _cdf(F.col("_mean")).alias("_cdf")), "rates")
    if rates.count() <= MOST_BROADCAST:
        rates = F.broadcast(rates)
    rows = carried(docs.select(*(f"`{c}`" for c in names)).withColumn("_key", own), "doc_id", "source", "_key")
    rows = rows.join(rates, F.col("source").eqNullSafe(F.col("_source")))
    one = lambda u: F.size(F.filter("_cdf", lambda c: c <= u))
    count = F.aggregate(F.sequence(F.lit(0), F.col("_draws") - 1), F.lit(0),
                        lambda acc, j: acc + one(hash_uniform(F.lit(seed), F.lit("count"), F.col("_key"), j)))
    rows = (rows.withColumn("_n", count).filter("_n > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))))
    rows = rows.withColumn("shuffle_key", hash52(F.lit(seed), F.lit("place"), F.col("_key"), F.col("copy")))
    rows = rows.select("doc_id", "source", "_rest", "copy", "shuffle_key").orderBy("shuffle_key", "doc_id", "copy")
    return rows.select(*restored(names, "doc_id", "source"), "copy", "shuffle_key")


MIX_SQL = """
WITH RECURSIVE by_source AS (SELECT source, sum(coalesce(length(text), 0)) AS size FROM documents GROUP BY source),
whole AS (SELECT count(*)::DOUBLE AS weights, sum(size) AS total FROM by_source),
rates AS (SELECT source, CASE WHEN size > 0 THEN 1.0::DOUBLE / weights * total::DOUBLE * 1.0::DOUBLE / size::DOUBLE ELSE 1.0::DOUBLE END AS rate FROM by_source, whole),
drawn AS (SELECT source, greatest(ceil(rate / 64.0::DOUBLE), 1)::INT AS draws, rate / greatest(ceil(rate / 64.0::DOUBLE), 1)::INT AS mean FROM rates),
cdf AS (
  SELECT source, draws, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM drawn
  UNION ALL
  SELECT source, draws, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < ceil(mean + 12 * sqrt(mean) + 30)),
tables AS (SELECT source, max(draws) AS draws, list(c ORDER BY k) AS cs FROM (SELECT * FROM cdf) GROUP BY source),
uniform AS (
  SELECT d.doc_id, t.cs, ('0x' || substr(md5('0:count:' || d.doc_id || ':' || j.j), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source, LATERAL (SELECT unnest(range(t.draws)) AS j) j),
counts AS (SELECT doc_id, sum(len(list_filter(cs, lambda c: c <= u)))::INT AS n FROM uniform GROUP BY doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INT AS copy,
       ('0x' || substr(md5('0:place:' || d.doc_id || ':' || c.copy), 1, 13))::BIGINT AS shuffle_key
FROM documents d JOIN (SELECT doc_id, unnest(range(n)) AS copy FROM counts) c ON d.doc_id = c.doc_id
"""
