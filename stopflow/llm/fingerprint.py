"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, range_bounds, range_of, shuffle_partitions

WORDS = 5  # per shingle
BITS = 48  # of a shingle's hash


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """The distinct hashes (0 to 2^48 - 1) of a text's shingles of lower-cased words.

    A text of fewer words has one shingle, all its words; one without words
    has none.
    """
    split = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def shingles(h: Column) -> Column:
        short = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) < words, short).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(words)))))
    hashes = let(F.transform(split, lambda w: F.xxhash64(w)), shingles)
    return F.array_distinct(F.transform(hashes, lambda x: F.shiftrightunsigned(x, 64 - BITS)))


def sketch(text: Column, fraction: float = 1 / 16, least: int = 64, words: int = WORDS) -> Column:
    """struct<t, hs>: every shingle hash below the threshold ``t``.

    ``t`` is the fixed ``fraction`` of the hash range; a text with so few
    shingles that fewer than ``least`` would be expected below it has the
    higher threshold ``least / shingles``, at most the whole range.  Since a
    sketch holds all hashes below its own threshold, sketches merge (union
    below the smaller threshold) and compare without bias whatever the sizes.
    """
    def kept(all_hashes: Column) -> Column:
        share = F.greatest(F.lit(fraction), F.least(F.lit(1.0), F.lit(float(least)) / F.greatest(F.size(all_hashes), F.lit(1))))
        return let(F.floor(share * float(2**BITS)), lambda t: F.struct(
            t.alias("t"), F.filter(all_hashes, lambda x: x < t).alias("hs")))
    return let(shingle_hashes(text, words), kept)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two sketched texts' joint shingles."""
    return let(F.least(a["t"], b["t"]), lambda t: F.struct(
        t.alias("t"), F.filter(F.array_union(a["hs"], b["hs"]), lambda x: x < t).alias("hs")))


def _shared(a: Column, b: Column) -> Column:
    """struct<i, a, b>: the hashes below both thresholds that are in both, in ``a`` and in ``b``."""
    below = lambda s, t: F.filter(s["hs"], lambda x: x < t)
    return let(F.least(a["t"], b["t"]), lambda t: let(
        F.struct(below(a, t).alias("a"), below(b, t).alias("b")), lambda s: F.struct(
            F.size(F.array_intersect(s["a"], s["b"])).alias("i"), F.size(s["a"]).alias("a"), F.size(s["b"]).alias("b"))))


def jaccard(a: Column, b: Column) -> Column:
    """Estimated shared share of all shingles, 0 to 1; two sketches without hashes in range are alike only if equal."""
    return let(_shared(a, b), lambda s: F.when(s["a"] + s["b"] > 0, s["i"] / (s["a"] + s["b"] - s["i"])).otherwise(
        F.when(F.size(a["hs"]) + F.size(b["hs"]) == 0, 1.0).otherwise(0.0)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has, 0 to 1; null if ``a`` has no hash in range."""
    return let(_shared(a, b), lambda s: F.when(s["a"] > 0, s["i"] / s["a"]))


def as_string(s: Column) -> Column:
    """The threshold and the ascending hashes in hexadecimal."""
    digits = F.transform(F.sort_array(s["hs"]), lambda x: F.lower(F.hex(x)))
    return F.concat_ws(":", F.lower(F.hex(s["t"])), F.concat_ws(",", digits))


def next_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n, to_id, to_n for distinct ids: ``to_id`` is the row before ``doc_id`` in descending order.

    That is the next larger id; the largest goes to the smallest.  Rows are
    dealt to ranges of ids by cut points; each range's first row, one per
    range, closes the gaps between them.
    """
    ranges = min(1024, 4 * shuffle_partitions(docs.sparkSession))
    rows = docs.withColumn("_r", range_of("doc_id", range_bounds(docs, "doc_id", ranges)))
    heads = rows.groupBy("_r").agg(F.min("doc_id").alias("head"), F.min_by("n", "doc_id").alias("head_n"))
    whole, after = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), Window.orderBy("_r")
    heads = heads.select("_r", *(F.coalesce(F.lead(c).over(after), F.first(c).over(whole)).alias(f"next_{c}") for c in ("head", "head_n")))
    w = Window.partitionBy("_r").orderBy("doc_id")
    rows = rows.withColumns({"lead_id": F.lead("doc_id").over(w), "lead_n": F.lead("n").over(w)})
    # at most as many rows as ranges
    return rows.join(F.broadcast(heads), "_r").select(
        "doc_id", "n", F.coalesce("lead_id", "next_head").alias("to_id"),
        F.when(F.col("lead_id").isNotNull(), F.col("lead_n")).otherwise(F.col("next_head_n")).alias("to_n"))


def edited_fingerprints(docs: DataFrame, fraction: float = 1 / 16, least: int = 64) -> DataFrame:
    """Fingerprints of every text and of its edited form, per distinct doc_id.

    The edited text ends in as many first code points of the next document
    (descending doc_id, the smallest wraps to the largest) as a third of the
    text has, in place of its own.  Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts count as empty.  Rows without a doc_id have no place in the
    order and are left out; of rows that share a doc_id the text with the
    smallest hash stands.  A single document is its own next one.  Other
    columns are ignored.

    A narrow pass finds each document's neighbour; texts are shuffled once,
    with their sketches, and each sends its sketch and only the code points
    needed to its neighbour.
    """
    rows = (docs.filter(F.col("doc_id").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    one = Window.partitionBy("doc_id").orderBy("x", "text")
    narrow = rows.select("doc_id", F.xxhash64("text").alias("x"), F.char_length("text").alias("n"))
    narrow = (narrow.withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("x", "n")))
              .filter("k = 1").select("doc_id", "n"))
    links = next_rows(narrow)
    sketched = (rows.withColumns({"x": F.xxhash64("text"), "s": sketch(F.col("text"), fraction, least)})
                .withColumn("k", F.row_number().over(one)).filter("k = 1").select("doc_id", "text", "s"))
    given = (sketched.withColumnRenamed("doc_id", "from_id").join(links, F.col("from_id") == F.col("doc_id"))
             .select("to_id", F.expr("substring(text, 1, cast(floor(to_n / 3) as int))").alias("head"), F.col("s").alias("next_s")))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, cast(char_length(text) - floor(char_length(text) / 3) as int))"), F.col("head"))
    out = (sketched.join(given, F.col("doc_id") == F.col("to_id"))
           .select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "s", "next_s"))
    out = out.withColumn("e", sketch(F.col("edited"), fraction, least))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      as_string(F.col("s")).alias("fingerprint"), as_string(F.col("e")).alias("edited_fingerprint"),
                      jaccard(F.col("s"), F.col("e")).alias("near_edited"), jaccard(F.col("s"), F.col("next_s")).alias("near_next"))
