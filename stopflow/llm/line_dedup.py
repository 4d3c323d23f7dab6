"""Removal of repeated multi-line passages by content-defined line chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, landed, let, restored

# Two independent chunkings: the factors of a rolling hash over a line's hash
# and the one before it.  A chunk ends where that hash, modulo a prime, is
# divisible by DIVISOR.
ROLLS = ((268435399, 179424673), (122949823, 217645177))
PRIME, DIVISOR = 2147483647, 2


def split_lines(text: Column) -> Column:
    """Lines with their ends; a line also ends after a full stop, exclamation or question mark and a space.

    Joined without a separator they give the text back.  Ends are marked by
    plain replacements, faster than a regular expression, unless the text has
    the mark itself.
    """
    mark, marked = "\1", text
    for end in ("\n", ". ", "! ", "? "):
        marked = F.replace(marked, F.lit(end), F.lit(end + mark))
    parts = F.when(F.contains(text, F.lit(mark)), F.split(text, r"(?<=\n)|(?<=[.!?] )")).otherwise(F.split(marked, mark))
    return F.filter(parts, lambda x: x != "")


def _chunks(lines: Column) -> Column:
    """array<struct<h, start, n>> of the chunks of at least two lines, of both chunkings (one that both have comes twice)."""
    def of(hashes: Column) -> Column:
        def one(a: int, b: int) -> Column:
            before = lambda i: F.coalesce(F.get(hashes, i - 1), F.lit(0))
            ends = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1),
                            lambda i: ((F.get(hashes, i) * a + before(i) * b) % PRIME % DIVISOR == 0) | (i == F.size(hashes) - 1))

            def cut(ends: Column) -> Column:
                spans = F.transform(ends, lambda e, j: let(
                    F.when(j == 0, F.lit(0)).otherwise(F.get(ends, j - 1) + 1),
                    lambda s: F.struct(s.alias("start"), (e - s + 1).alias("n"))))
                return F.transform(F.filter(spans, lambda x: x["n"] >= 2), lambda x: F.struct(
                    F.xxhash64(F.slice(lines, x["start"] + 1, x["n"])).alias("h"), x["start"].alias("start"), x["n"].alias("n")))
            return let(ends, cut)
        return F.concat(*(one(a, b) for a, b in ROLLS))
    hashed = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long"))
    return let(hashed, lambda h: F.when(F.size(h) > 0, of(h)))


def _pairs(lines: Column) -> Column:
    """array<struct<h, start, n>> of every two neighbouring lines."""
    return F.when(F.size(lines) > 1, F.transform(F.sequence(F.lit(0), F.size(lines) - 2), lambda i: F.struct(
        F.xxhash64(F.slice(lines, i + 1, F.lit(2))).alias("h"), i.alias("start"), F.lit(2).alias("n"))))


def dedup_lines(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``docs`` with repeated chunks removed from ``text``; adds n_lines and n_removed.

    Lines (see ``split_lines``) are hashed, and a rolling hash over each line
    and the one before it chooses chunk ends, so that ends inside a shared
    passage fall alike wherever the passage stands.  Of every chunk of two or
    more lines, the occurrence with the smallest (doc_id, place) stays and all
    others are removed.  Two independent chunkings are used at once; a line
    goes if it lies in a removed chunk of either.  A removed line always has
    an equal one at an earlier place, so no content is lost.

    Only a passage's inner chunks go that way, few or none of a short one's.
    ``whole`` takes every two neighbouring lines as a chunk instead, so that a
    repeated passage of two or more lines goes wholly, whatever stands beside
    it.  Two places of a chunk that share a line don't repeat each other.

    A null text stays null; a text may become empty, its row stays.  Rows of
    equal doc_id and text count as one document and are treated alike; rows
    that share a doc_id but not the text keep a chunk that both hold at the
    same place.  A null doc_id comes after all others.  Input columns named
    n_lines or n_removed are replaced; n_chars, if there, is counted anew.

    Steps: (1) narrow rows (hash, place) are aggregated to the first place of
    each repeated hash; a chunk in a third of all texts is one row per map
    task.  (2) The places of repeated chunks are joined by hash (written
    tables, so AQE can split hot hashes) and grouped by document.  (3) Texts
    are shuffled by document to compare the bytes of the chunks: a hash that
    stands for different bytes removes nothing.  (4) Whole rows are shuffled
    by document for the result; each step's shuffle files go before the next.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keyed = carried(docs.select(*(f"`{c}`" for c in names if c != "n_chars")), "doc_id", "text")
    keyed = keyed.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), "_x": F.xxhash64("text")})
    # made where needed only: fixed-size buffers for hash aggregation, but wide to store and shuffle
    place = (F.col("_id").cast("decimal(38,0)") * F.lit(2**31).cast("decimal(11,0)") + F.col("start")).cast("decimal(38,0)")
    spread = (keyed.select("_id", "_x", F.explode(let(split_lines(F.col("text")), _pairs if whole else _chunks)).alias("c"))
              .select("_id", "_x", "c.*"))
    spread = landed(spread, "chunks")
    later = place >= F.col("first") + F.col("n") if whole else place > F.col("first")
    firsts = landed(spread.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                         .filter("first < last").select(F.col("h").alias("of"), "first"), "repeated")
    repeated = landed(spread.join(firsts, F.col("h") == F.col("of"))
                           .select("_id", "_x", "h", "start", "n", later.alias("later")), "places")
    texts = keyed

    wanted = repeated.groupBy(F.col("_id").alias("w_id"), F.col("_x").alias("w_x")).agg(
        F.collect_set(F.struct("h", "start", "n")).alias("cs"))
    bytes_of = let(split_lines(F.col("text")), lambda lines: F.transform("cs", lambda c: F.struct(
        c["h"].alias("h"), F.array_join(F.slice(lines, c["start"] + 1, c["n"]), "").alias("b"))))
    unequal = (texts.join(wanted, (F.col("_id") == F.col("w_id")) & (F.col("_x") == F.col("w_x")))
               .select(F.explode(bytes_of).alias("c")).select("c.h", "c.b").distinct()
               .groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    unequal = landed(unequal, "unequal")
    gone = (repeated.filter("later").join(unequal, "h", "left_anti")
            .groupBy(F.col("_id").alias("w_id"), F.col("_x").alias("w_x")).agg(F.collect_set(F.struct("start", "n")).alias("cs")))
    joined = texts.join(gone, (F.col("_id") == F.col("w_id")) & (F.col("_x") == F.col("w_x")), "left")

    lost = F.flatten(F.transform("cs", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))
    # one pass over the lines: struct of their number, the number removed and the text
    kept = let(split_lines(F.col("text")), lambda lines: F.when(F.col("cs").isNull() | F.col("text").isNull(), F.struct(
        F.size(lines).alias("n_lines"), F.lit(0).alias("n_removed"), F.col("text").alias("text"))).otherwise(
        let(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost), lambda stay: F.struct(
            F.size(lines).alias("n_lines"), (F.size(lines) - F.size(stay)).alias("n_removed"),
            F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "").alias("text")))))
    out = joined.withColumn("_kept", kept)
    lines = F.greatest(F.coalesce(F.col("_kept.n_lines"), F.lit(0)), F.lit(0))
    out = out.select("doc_id", "_rest", F.col("_kept.text").alias("text"), F.char_length("_kept.text").cast("long").alias("n_chars"),
                     lines.alias("n_lines"), F.coalesce(F.col("_kept.n_removed"), F.lit(0)).alias("n_removed"))
    return out.select(*restored(names, "doc_id", "text", "n_chars"), "n_lines", "n_removed")


_ROLLS_SQL = ", ".join(f"({k}, {a}, {b})" for k, (a, b) in enumerate(ROLLS))
LINE_DEDUP_SQL = f"""
WITH cut AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(text, '(\\n|[.!?] )', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM cut),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
rolls(k, a, b) AS (VALUES {_ROLLS_SQL}),
rolled AS (
  SELECT doc_id, i, line, k,
         (h * a + coalesce(lag(h) OVER w, 0) * b) % {PRIME} % {DIVISOR} = 0 OR lead(i) OVER w IS NULL AS ends
  FROM hashed, rolls WINDOW w AS (PARTITION BY doc_id, k ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM rolled),
chunks AS (SELECT doc_id, k, c, min(i) AS start, count(*) AS n, string_agg(line, '' ORDER BY i) AS bytes, list(line ORDER BY i) AS parts
           FROM numbered GROUP BY doc_id, k, c HAVING count(*) >= 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY parts ORDER BY doc_id, start) AS r, dense_rank() OVER (PARTITION BY parts ORDER BY doc_id, start) AS place FROM chunks),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + n)) AS i FROM ranked WHERE place > 1),
kept AS (SELECT l.doc_id, string_agg(l.line, '' ORDER BY l.i) AS text, count(*) AS n FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, d.lang, d.source,
       length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END)::BIGINT AS n_chars,
       coalesce(len(c.ls), 0)::INT AS n_lines, (coalesce(len(c.ls), 0) - coalesce(k.n, 0))::INT AS n_removed
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

# Two neighbouring lines go where they stand at an earlier place too, not over a line of their first place.
PASSAGE_DEDUP_SQL = f"""
WITH cut AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(text, '(\\n|[.!?] )', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM cut),
pairs AS (SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS after, doc_id::HUGEINT * {2**31} + i AS place FROM lines),
ranked AS (SELECT doc_id, i, place, min(place) OVER (PARTITION BY line, after) AS first FROM pairs WHERE after IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([i, i + 1]) AS i FROM ranked WHERE place >= first + 2),
kept AS (SELECT l.doc_id, string_agg(l.line, '' ORDER BY l.i) AS text, count(*) AS n FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, d.lang, d.source,
       length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END)::BIGINT AS n_chars,
       coalesce(len(c.ls), 0)::INT AS n_lines, (coalesce(len(c.ls), 0) - coalesce(k.n, 0))::INT AS n_removed
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
