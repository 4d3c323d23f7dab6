"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import landed, let

# The benchmark's windows are broadcast up to this many bytes of text, counted
# first; beyond it the same join runs as a shuffle.
MOST_BROADCAST_BYTES = 16 << 20
# The bitmap of the benchmark's fingerprints has 64 bits for each of them,
# within these bounds (2 MB at most); a fuller one lets more through, and loses none.
FEWEST_BITS, MOST_BITS = 1 << 16, 1 << 24

_UPPER = "".join(map(chr, range(0x41, 0x5B)))
_BREAKS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def text_words(text: Column) -> Column:
    """Words of ASCII digits and letters, lower-cased, and all characters beyond ASCII."""
    plain = F.translate(text, _UPPER + _BREAKS, _UPPER.lower() + " " * len(_BREAKS))
    return F.filter(F.split(F.coalesce(plain, F.lit("")), " "), lambda x: x != "")


def _gram(length: int) -> int:
    """k of a window of ``length`` words: k-grams, of which it has length - k + 1."""
    return (length + 1) // 2


def _winnowed(hashes: Column, length: int) -> Column:
    """array<struct<len, f, a, b>>: the windows a to b - 1 of ``length`` words have f as their least k-gram hash.

    Neighbouring windows mostly share their least hash, and only one row for
    each such run is kept: that is the fingerprint.
    """
    k = _gram(length)
    size = F.size(hashes)

    def least(grams: Column) -> Column:
        windows = F.sequence(F.lit(0), size - length)
        per = length - k + 1
        return F.transform(windows, lambda i: F.least(*(F.get(grams, i + j) for j in range(per))) if per > 1 else F.get(grams, i))

    def runs(m: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda a, j: F.struct(
            F.lit(length).alias("len"), F.get(m, a).alias("f"), a.alias("a"), F.coalesce(F.get(s, j + 1), F.size(m)).alias("b"))))

    grams = F.transform(F.sequence(F.lit(0), size - k), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k))))
    empty = F.array().cast("array<struct<len:int,f:bigint,a:int,b:int>>")
    return F.when(size >= length, let(let(grams, least), runs)).otherwise(empty)


def fingerprints(words: Column, lengths: list[int]) -> Column:
    """The runs of ``_winnowed`` for windows of each of ``lengths`` words."""
    return let(F.transform(words, lambda w: F.xxhash64(w)),
               lambda h: F.concat(*(_winnowed(h, n) for n in lengths)))


def benchmark_windows(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Distinct item, len, words (joined by spaces): every run of ``window`` words of each item, or a shorter item whole.

    ``item`` is item_id as text, a null one the empty string; items without words have no window.
    """
    size = F.size("ws")
    length = F.least(size, F.lit(window))
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_words(F.col("text")).alias("ws"))
    rows = rows.filter(size > 0).select("item", length.alias("len"), F.explode(F.transform(
        F.sequence(F.lit(0), size - length), lambda i: F.array_join(F.slice("ws", i + 1, length), " "))).alias("words"))
    return rows.distinct()


def _bitmap(windows: DataFrame, lengths: list[int]) -> list[int]:
    """The fingerprints of the benchmark as bits of longs: at most MOST_BITS of them."""
    if not lengths:
        return []
    found = windows.select("words", "len").distinct().select("len", F.explode(fingerprints(F.split("words", " "), lengths)).alias("r"))
    found = landed(found.filter("r.len = len").select("r.f").distinct(), "benchmark-fingerprints")
    n = min(MOST_BITS, max(FEWEST_BITS, 1 << (64 * found.count()).bit_length()))
    at = F.pmod("f", F.lit(n))
    rows = (found.groupBy(F.floor(at / 64).cast("int").alias("k"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))).alias("bits")).collect())
    out = [0] * (n // 64)
    for r in rows:
        out[r.k] = r.bits
    return out


def _suspects(ws: Column, lengths: list[int], bits: list[int]) -> Column:
    """array<struct<len, start, words>> of the windows whose fingerprint is in the bitmap."""
    table = F.from_json(F.lit(str(bits)), "array<bigint>")  # a constant, folded once

    def known(f: Column) -> Column:
        at = F.pmod(f, F.lit(64 * len(bits)))
        return F.get(table, F.floor(at / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))) != 0

    return F.flatten(F.transform(F.filter(fingerprints(ws, lengths), lambda r: known(r["f"])), lambda r: F.transform(
        F.sequence(r["a"], r["b"] - 1), lambda i: F.struct(
            r["len"].alias("len"), i.alias("start"), F.array_join(F.slice(ws, i + 1, r["len"]), " ").alias("words")))))


def _bounded(df: DataFrame, size: Column) -> DataFrame:
    """``df``, to be broadcast if its rows are counted to be small."""
    total = df.agg(F.sum(size + 32).alias("b")).first().b or 0
    return F.broadcast(df) if total <= MOST_BROADCAST_BYTES else df


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and spans for every row of ``docs`` (doc_id, text).

    A word is hit if it lies in an occurrence of a benchmark window (see
    ``benchmark_windows``); ``spans`` are the maximal runs [start, end) of hit
    words.  Items are those with an occurring window; items_sha256 hashes
    their ids, sorted as strings and joined by commas.

    1. Winnowing: of each window the least of its k-gram hashes is kept, with
       k half the window, one row per run of windows that share it.  A window
       in a document and in the benchmark has the same words, so the same
       least hash: no shared window can be missed.
    2. Documents' fingerprints meet those of the benchmark in a bitmap, while
       the text is at hand; of most texts nothing passes.  One row per
       document carries its number of words along.
    3. The windows that matching fingerprints stand for leave the text as
       words and are joined to the benchmark's by them, not by a hash.
    4. Found windows are extended: overlapping and touching ones merge into
       spans.  Windows with the same set of items (number, sum and exclusive
       or of the items' hashes) are one class, so a passage that many items
       share is listed once per document before the items are.

    Null, empty and blank texts have no words.  Rows of equal doc_id and text
    are treated alike, each giving a row; a null doc_id stays null.  Rows
    that share an item_id are one item.  Either table may be empty; other
    columns are ignored.  Each text is read once and never shuffled.  The benchmark's
    windows are broadcast behind a check of their bytes.
    """
    windows = landed(benchmark_windows(benchmark, window), "windows")
    lengths = sorted(r.len for r in windows.select("len").distinct().collect())  # at most ``window`` numbers
    bits = _bitmap(windows, lengths)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("x"), "text")
    spread = rows.select("doc_id", "x", F.explode(let(text_words(F.col("text")), lambda ws: F.concat(
        F.array(F.struct(F.lit(0).alias("len"), F.size(ws).alias("start"), F.lit(None).cast("string").alias("words"))),
        *([_suspects(ws, lengths, bits)] if lengths else [])))).alias("w")).select("doc_id", "x", "w.*")
    met = landed(spread, "suspects")
    every = met.filter("len = 0").select("doc_id", "x", F.col("start").cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("x") == F.col("o_x"))
    owner = [F.col("doc_id").alias("o_id"), F.col("x").alias("o_x")]
    found = met.filter("len > 0").distinct()

    number = F.xxhash64("item")
    classes = windows.groupBy("words", "len").agg(F.count("*").alias("n"), F.sum(number.cast("decimal(38,0)")).alias("s"), F.bit_xor(number).alias("o"))
    classes = landed(classes, "classes")
    shown = classes.groupBy("n", "s", "o").agg(F.min("words").alias("shown"))
    named = landed(classes.join(shown, ["n", "s", "o"]).select(F.col("words").alias("c_words"), "shown"), "named")
    # windows of other lengths have other numbers of words, so words alone are the key
    hits = found.join(_bounded(named, F.octet_length("c_words") + F.octet_length("shown")), F.col("words") == F.col("c_words"))
    hits = landed(hits.select("doc_id", "x", "start", "len", "shown"), "hits")

    def merged(ordered: Column) -> Column:
        """Sorted intervals as spans."""
        empty = F.array().cast("array<struct<start:int,end:int>>")

        def add(acc: Column, w: Column) -> Column:
            last = F.try_element_at(acc, F.lit(-1))
            grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], w["end"]).alias("end"))
            return F.when(F.coalesce(last["end"] >= w["start"], F.lit(False)), F.array_append(
                F.slice(acc, 1, F.size(acc) - 1), grown)).otherwise(F.array_append(acc, w))
        return F.aggregate(ordered, empty, add)

    spans = hits.groupBy(*owner).agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("ws"))
    spans = spans.select("o_id", "o_x", merged(F.col("ws")).alias("spans"))
    items = (hits.select("doc_id", "x", "shown").distinct()
             .join(windows.select("item", F.col("words").alias("i_words")), F.col("shown") == F.col("i_words"))
             .groupBy(*owner).agg(F.sort_array(F.collect_set("item")).alias("items")))
    facts = landed(spans.alias("s").join(items.alias("i"), F.col("s.o_id").eqNullSafe(F.col("i.o_id")) & (F.col("s.o_x") == F.col("i.o_x")))
                   .select("s.o_id", "s.o_x", "spans", F.size("items").cast("long").alias("n_items"),
                           F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")), "contaminated")
    out = every.join(facts, same, "left")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0), lambda acc, s: acc + s["end"] - s["start"]), F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                      F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))


CONTAMINATION_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
spread AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
           FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes WHERE len(ws) >= n)),
hits AS (SELECT s.doc_id, s.i, s.n, w.item_id FROM spread s JOIN windows w ON s.n = w.n AND s.w = w.w),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(f.n_items, 0)::BIGINT AS n_items,
       coalesce(f.items_sha256, sha256('')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id
"""
