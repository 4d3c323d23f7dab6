"""Interaction audit of text filters: what each removes in every order."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed

# The transducer.  Classes of bytes, and two states: between words and in one.
WHITE, CAPITAL, SYMBOL, INSIDE, OTHER = range(5)
BETWEEN, WORD = range(2)
# What a step can emit.
BEGINS, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8
# Texts are read in slabs of about this many bytes; words of at least LONG
# bytes are few in a slab and kept as bytes.
SLAB, LONG = 1 << 22, 1 << 10


def _classes() -> np.ndarray:
    """The class of each byte; bytes 80 to BF continue a code point."""
    table = np.full(256, OTHER, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = WHITE
    table[ord("A"):ord("Z") + 1] = CAPITAL
    table[[ord(c) for c in "#$%&*|"]] = SYMBOL
    table[0x80:0xC0] = INSIDE
    return table


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """The next state and the emission by (state, class)."""
    after, emit = np.zeros((2, 5), np.uint8), np.zeros((2, 5), np.uint8)
    for state in (BETWEEN, WORD):
        for kind in range(5):
            after[state, kind] = BETWEEN if kind == WHITE else WORD
            emit[state, kind] = (BEGINS * (state == BETWEEN and kind != WHITE) | IS_CAPITAL * (kind == CAPITAL)
                                 | IS_SYMBOL * (kind == SYMBOL) | IS_POINT * (kind != INSIDE))
    return after, emit


CLASSES = _classes()
AFTER, EMIT = _steps()


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; ``data`` has eight more bytes than places."""
    return np.ndarray(len(data) - 8, "<u8", data.tobytes(), strides=(1,))


def _masked(eights: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes of each word from ``at``, those beyond its ``left`` bytes as zero."""
    cut = (np.uint64(8) - np.minimum(left, 8).astype(np.uint64)) * np.uint64(8)
    return (eights[at] << cut) >> cut


def _hashes(eights: np.ndarray, start: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
    h = (owner.astype(np.uint64) << np.uint64(32)) ^ size.astype(np.uint64)
    at, done = np.arange(len(start)), 0
    while len(at):
        x = h[at] ^ _masked(eights, start[at] + done, size[at] - done)
        x *= np.uint64(0x9E3779B97F4A7C15)
        h[at] = x ^ (x >> np.uint64(31))
        done += 8
        at = at[size[at] > done]
    return h


def _equal(eights: np.ndarray, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words a[i] and b[i], of equal size, have the same bytes."""
    same, at, done = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(at):
        left = size[a[at]] - done
        same[at] = _masked(eights, start[a[at]] + done, left) == _masked(eights, start[b[at]] + done, left)
        done += 8
        at = at[same[at] & (size[a[at]] > done)]
    return same


def distinct_spans(eights: np.ndarray, start: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The first of each distinct (owner, bytes) among the words: an open-addressing hash table, filled in rounds.

    In a round every word not yet settled looks at its slot; the first word
    to come to a free slot takes it.  A word whose slot holds the same bytes
    of the same owner (compared, not just hashed) is settled; the others go
    on to the next slot.
    """
    room = 1 << max(4, int(2 * len(start)).bit_length())
    table = np.full(room, -1, np.int64)
    slot = (_hashes(eights, start, size, owner) >> np.uint64(7)).astype(np.int64) & (room - 1)
    todo = np.arange(len(start))
    while len(todo):
        free = todo[table[slot[todo]] < 0][::-1]
        table[slot[free]] = free  # in reverse, so the first word comes last and stays
        held = table[slot[todo]]
        alike = (owner[held] == owner[todo]) & (size[held] == size[todo])
        alike[alike] = _equal(eights, start, size, todo[alike], held[alike])
        todo = todo[~alike]
        slot[todo] = (slot[todo] + 1) & (room - 1)
    return table[table >= 0]


def _slabs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (text, begin, end) of about SLAB bytes; a longer text is cut after white space."""
    out, held = [], 0
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        while b - a > SLAB:
            end, step = a + SLAB, SLAB
            while end < b:
                white = np.flatnonzero(CLASSES[data[end - step:end]] == WHITE)
                if len(white):
                    end = end - step + int(white[-1]) + 1
                    break
                step = min(SLAB, b - end)
                end += step
            if out:
                yield out
            yield [(k, a, end)]
            out, held, a = [], 0, end
        out.append((k, a, b))
        held += b - a
        if held >= SLAB:
            yield out
            out, held = [], 0
    if out:
        yield out


def measure(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """words, distinct words, capitals, symbols and code points of each text data[starts[i]:ends[i]]."""
    out = np.zeros((len(starts), 5), np.int64)
    several = np.flatnonzero(ends - starts > SLAB)
    seen: dict[int, set[bytes]] = {int(k): set() for k in several}
    for slab in _slabs(data, starts, ends):
        who, a, b = (np.array(x, np.int64) for x in zip(*slab, strict=True))
        sizes = b - a
        if not sizes.sum():
            continue
        first, last = int(a[0]), int(b[-1])
        part = np.zeros(last - first + 8, np.uint8)
        part[:-8] = data[first:last]
        kinds = CLASSES[part[:-8]]
        # the next state depends on the class alone, so each state is the step before looked up
        state = np.empty(len(kinds), np.uint8)
        state[0] = BETWEEN
        state[1:] = AFTER[BETWEEN, kinds[:-1]]
        here = sizes > 0
        state[a[here] - first] = BETWEEN
        said = EMIT[state, kinds]
        spots = a[here] - first
        for column, flag in ((2, IS_CAPITAL), (3, IS_SYMBOL), (4, IS_POINT)):
            np.add.at(out[:, column], who[here], np.add.reduceat((said & flag) != 0, spots, dtype=np.int64))
        start = np.flatnonzero(said & BEGINS)
        if not len(start):
            continue
        text = np.searchsorted(spots, start, "right") - 1
        stops = np.flatnonzero(kinds == WHITE)
        nearest = np.append(stops, len(kinds))[np.searchsorted(stops, start)]
        size = np.minimum(nearest, (b[here] - first)[text]) - start
        owner = who[here][text]
        np.add.at(out[:, 0], owner, 1)
        long = size >= LONG
        for k, s, n in zip(owner[long].tolist(), start[long].tolist(), size[long].tolist(), strict=True):
            seen.setdefault(k, set()).add(part[s:s + n].tobytes())
        start, size, owner = start[~long], size[~long], owner[~long]
        heads = distinct_spans(_eights(part), start, size, owner)
        many = np.isin(owner[heads], several)
        for h in heads[many].tolist():
            seen[int(owner[h])].add(part[start[h]:start[h] + size[h]].tobytes())
        np.add.at(out[:, 1], owner[heads[~many]], 1)
    for k, words in seen.items():
        out[k, 1] += len(words)
    return out


_MEASURES = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")


def text_measures(docs: DataFrame) -> DataFrame:
    """doc_id, part, n_words, n_distinct, n_capitals, n_symbols, n_points and digest of every row of ``docs`` (doc_id, text, lang).

    One pass of a table-driven transducer over the UTF-8 bytes of the whole
    text: a class for each byte, a state (in a word or between words), and by
    both of them what the byte counts as and whether a word begins.  Words
    are runs without ASCII white space, case kept; the spans found go into a
    hash table that compares bytes.  ``part`` is lang, null as empty; a null
    text is empty; ``digest`` is the text's SHA-256.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(2)
            text = text if pa.types.is_large_string(text.type) else text.cast(pa.large_string())
            bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            found = measure(data, bounds[:-1], bounds[1:])
            digests = [sha256(data[a:b]).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in found.T), pa.array(digests, pa.binary())],
                                             names=["doc_id", "part", *_MEASURES, "digest"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, " + ", ".join(f"{c} long" for c in _MEASURES) + ", digest binary")


# What fails each filter, over the columns of text_measures; E is the repeated text.
CONDITIONS = {"A": "n_words < 100", "B": "100 * n_distinct < 80 * n_words", "C": "100 * n_capitals > 10 * n_points", "D": "n_symbols > 0"}
REPEATS = "E"


def failing_counts(docs: DataFrame, labels: DataFrame, conditions: dict[str, str] = CONDITIONS) -> DataFrame:
    """part, fails, n, good, toxic: rows of ``docs`` by the letters of the filters that they fail.

    A row fails REPEATS if a row with a smaller doc_id has the identical text
    (by SHA-256); a null doc_id counts as larger than all others, rows of one
    doc_id don't repeat each other.  ``labels`` (doc_id, quality, toxic)
    marks a document as good or toxic if any row of its doc_id has a 1;
    rows without an id have no labels.
    """
    letters = F.concat(*(F.when(F.expr(c), name).otherwise("") for name, c in conditions.items()))
    rows = landed(text_measures(docs).select("doc_id", "part", letters.alias("fails"), "digest"), "measures")
    own = F.coalesce("doc_id", F.lit(2**63 - 1))
    firsts = landed(rows.groupBy("digest").agg(F.min(own).alias("first"), F.count("*").alias("times"))
                    .filter("times > 1").select(F.col("digest").alias("of"), "first"), "firsts")
    fails = F.concat("fails", F.when(F.col("first") < own, REPEATS).otherwise(""))
    rows = rows.join(firsts, F.col("digest") == F.col("of"), "left").select("doc_id", "part", fails.alias("fails"))
    rows = landed(rows.groupBy("doc_id", "part", "fails").agg(F.count("*").alias("n")), "by-document")
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = landed(labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("l_id"))
                   .agg(flag("quality").alias("is_good"), flag("toxic").alias("is_toxic")), "marks")
    of = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    return (rows.join(marks, F.col("doc_id") == F.col("l_id"), "left").groupBy("part", "fails")
            .agg(F.sum("n").alias("n"), of("is_good").alias("good"), of("is_toxic").alias("toxic")))


def filter_audit(docs: DataFrame, labels: DataFrame, conditions: dict[str, str] = CONDITIONS) -> DataFrame:
    """What each step of every order of the filters does, per part of ``docs``.

    Columns: part, filter_order, step (from 1), kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley (see ``failing_counts`` for
    parts and labels).  All numbers follow from the counts by set of failed
    filters, at most 32 rows a part, so no text is filtered once per order.
    A filter is the first of the m that a document fails in 1/m of all
    orders, which gives ``shapley``.  Each part has all orders and steps; an
    empty table has no parts.  Other columns of either table are ignored.
    """
    names = [*conditions, REPEATS]
    orders = ["".join(p) for p in permutations(names)]
    sets = landed(failing_counts(docs, labels, conditions), "sets")
    rows = (sets.withColumn("filter_order", F.explode(F.lit(orders)))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names))))))
    this = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    before = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    hit = F.contains("fails", this)
    passed = lambda letters: F.length(F.call_function("translate", letters, F.col("fails"), F.lit(""))) == F.length(letters)
    first, left = hit & passed(before), passed(F.concat(before, this))
    total = lambda when, what="n": F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0))
    share = F.when(hit, F.expr(f"n * ({len(orders)} div length(fails))"))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(left).alias("kept"), total(first).alias("removed"), total(hit & ~first).alias("redundant"),
        total(hit & (F.length("fails") == 1)).alias("unique_fails"), total(first, "good").alias("good_lost"),
        total(first, "toxic").alias("toxic_lost"), F.coalesce(F.sum(share), F.lit(0)).alias("shapley"))


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
facts AS (
  SELECT part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN min(w.doc_id) OVER (PARTITION BY t) < w.doc_id THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN marks m ON w.doc_id = m.doc_id),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, s, o[s] AS x, substr(o, 1, s - 1) AS before FROM orders, range(1, 6) r(s)),
sets AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM facts GROUP BY part, fails),
each AS (SELECT part, o, s, x, fails, n, good, toxic, contains(fails, x) AS hit, translate(before, fails, '') = before AS open FROM sets, steps),
removed AS (
  SELECT part, o, s, x, coalesce(sum(n) FILTER (open AND NOT hit), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (open AND hit), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND NOT open), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = x), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (open AND hit), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (open AND hit), 0)::BIGINT AS toxic_lost
  FROM each GROUP BY part, o, s, x)
SELECT part, o AS filter_order, s::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM removed
"""
