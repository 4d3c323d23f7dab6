"""Exact Jaccard self-join on word n-grams by rare-first prefix filtering."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, landed
from .spans import word_hashes

# Ids and sets are looked up by broadcasting ids only up to this many.
MOST_BROADCAST = 1_000_000
# Sets are counted by blocks of documents against ranges of hashes, each of
# about so many shingles.
BLOCK, SHARD = 1 << 19, 1 << 20
# The search for candidates keeps so many bytes of each shingle's hash; pairs
# are verified on whole hashes.
KEPT = 5
_SIGNATURE = ("s0", "s1", "s2", "s3")


def _mixed(h: np.ndarray, words: int) -> np.ndarray:
    """The hash of every run of ``words`` word hashes (of all of them, if fewer), in order."""
    k = min(words, len(h))
    x = np.full(len(h) - k + 1 if k else 0, k, np.uint64)
    for j in range(k):
        x = (x ^ h[j:len(h) - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return x


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The distinct hashes of each text's shingles, ascending.

    Words are runs without ASCII white space, A-Z lower-cased.  Fewer than
    ``words`` words are one shingle together; none give the empty set.
    """
    texts = texts if pa.types.is_large_string(texts.type) else texts.cast(pa.large_string())
    texts = texts.fill_null("") if texts.null_count else texts
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    h, at = word_hashes(np.frombuffer(texts.buffers()[2] or b"", np.uint8), bounds)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        s = np.sort(_mixed(h[a:b], words))
        yield s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def _short(s: np.ndarray) -> np.ndarray:
    """The first KEPT bytes of each hash of a set, ascending and distinct."""
    v = s >> np.uint64(64 - 8 * KEPT)
    return v[np.append(True, v[1:] != v[:-1])] if len(v) else v


def _pack(v: np.ndarray) -> bytes:
    """Numbers of KEPT bytes."""
    return np.ascontiguousarray(v, "<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEPT, 8), np.uint8)
    out[:, :KEPT] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT)
    return out.view("<u8").ravel()


def _least_shared(total: np.ndarray | Column, share: tuple[int, int]):
    """The least intersection of two linked sets of ``total`` elements together."""
    num, den = share
    return -(-num * total // (num + den)) if not isinstance(total, Column) else F.ceil(total * num / F.lit(float(num + den)) - 1e-9)


def _prefix_length(n: int, share: tuple[int, int]) -> int:
    """How many of the rarest shingles must hold one that a linked, different set has too; 0 if no such set can be."""
    num, den = share
    if den * n < num * (n + 1) and den * (n - 1) < num * n:
        return 0
    return n + num * n // -den + 1


_SET = "block long, digest binary, content binary, n long, size long, s0 long, s1 long, s2 long, s3 long, shingles binary"


def _sets(words: int):
    """Of each distinct text its set with a digest, size and parity signature, in blocks of about BLOCK shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            rows = []
            for content, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1), words), strict=True):
                if held > BLOCK:
                    block, held = block + 1, 0
                held += len(s)
                v = _short(s)
                odd = np.bincount((v & np.uint64(255)).astype(np.int64), minlength=256) & 1
                sig = np.packbits(odd.astype(np.uint8)).view("<i8").tolist()
                rows.append((block, blake2b(s.tobytes(), digest_size=16).digest(), content, len(s), len(v), *sig, _pack(v)))
            cols = list(zip(*rows, strict=True)) or [()] * 10
            kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=[c.split()[0] for c in _SET.split(", ")])
    return run


def _joined(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return _unpack(b"".join(column.to_pylist()))


def _by_shard(shards: int):
    """The distinct shingles of each block, cut into equal ranges of hashes, with the number of its sets that have them (65,535 at most)."""
    width = (1 << 8 * KEPT) // shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array([k * width for k in range(1, shards)], np.uint64)
        for b in batches:
            blocks = b.column(0).to_numpy()
            out = [[], [], [], []]
            for block in np.unique(blocks):
                s = np.sort(_joined(b.column(1).filter(pa.array(blocks == block))))
                first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
                s, seen = s[first], np.minimum(np.diff(np.append(first, len(s))), 2**16 - 1).astype(np.uint16)
                ends = [0, *np.searchsorted(s, cuts).tolist(), len(s)]
                for k, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                    if x < y:
                        for col, v in zip(out, (int(block), k, _pack(s[x:y]), seen[x:y].tobytes()), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                                             names=["block", "shard", "shingles", "seen"])
    return run


def _counted(rows: pa.Table) -> pa.Table:
    """Of one range of hashes, the shingles of each block that several sets have, and how many have them (65,535 at most: any order is exact)."""
    s, seen = _joined(rows.column("shingles")), np.frombuffer(b"".join(rows.column("seen").to_pylist()), np.uint16)
    order = np.argsort(s, kind="stable")
    starts = np.flatnonzero(np.append(True, s[order][1:] != s[order][:-1])) if len(s) else np.zeros(0, np.int64)
    total = np.add.reduceat(seen[order].astype(np.int64), starts) if len(s) else np.zeros(0, np.int64)
    df = np.empty(len(s), np.int64)
    df[order] = np.repeat(total, np.diff(np.append(starts, len(s))))
    sizes = [len(x) // KEPT for x in rows.column("shingles").to_pylist()]
    out = [[], [], []]
    for block, b in zip(rows.column("block").to_pylist(), np.cumsum(sizes).tolist(), strict=True):
        a = b - sizes[len(out[0])]
        often = df[a:b] > 1
        for col, v in zip(out, (block, _pack(s[a:b][often]), np.minimum(df[a:b][often], 2**16 - 1).astype(np.uint16).tobytes()), strict=True):
            col.append(v)
    return pa.table([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["of", "common", "times"])


def _prefixes(share: tuple[int, int]):
    """The rarest shingles of each set of a block, without those that no other set has: (token, c, pos, n).

    ``pos`` counts all shingles, in the order of frequency, then hash.
    """
    def run(sets: pa.Table, counts: pa.Table) -> pa.Table:
        common, times = _joined(counts.column("common")), np.frombuffer(b"".join(counts.column("times").to_pylist()), np.uint16)
        order = np.argsort(common)
        common, times = common[order], times[order]
        out = [[], [], [], []]
        for c, raw in zip(sets.column("c").to_pylist(), sets.column("shingles").to_pylist(), strict=True) if len(common) else ():
            s = _unpack(raw)
            p = _prefix_length(len(s), share)
            at = np.minimum(np.searchsorted(common, s), len(common) - 1)
            met = common[at] == s
            alone = len(s) - int(met.sum())
            if p <= alone:
                continue
            often, df = s[met], times[at[met]]
            head = often[np.lexsort((often, df))[:p - alone]]
            for col, x in zip(out, (head.view(np.int64), np.full(len(head), c), np.arange(alone, p), np.full(len(head), len(s))), strict=True):
                col.append(x)
        kinds = (np.int64, np.int64, np.int32, np.int64)
        return pa.table([pa.array(np.concatenate([np.zeros(0, k), *c]).astype(k)) for c, k in zip(out, kinds, strict=True)], names=["token", "c", "pos", "n"])
    return run


def _whole(words: int):
    """Whole hashes of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.tobytes() for s in shingle_sets(b.column(1), words)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["of", "shingles"])
    return run


def _verify(share: tuple[int, int]):
    """Keeps the pairs whose whole sets are similar enough."""
    cuts = (np.arange(1, 16, dtype=np.uint64) << np.uint64(60))

    def linked(x: bytes, y: bytes) -> bool:
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        need = _least_shared(len(a) + len(b), share)
        # suffix filter: sixteen ranges of hashes can't share more than the smaller part of each
        parts = [np.diff(np.searchsorted(s, cuts), prepend=0, append=len(s)) for s in (a, b)]
        if np.minimum(*parts).sum() < need:
            return False
        return len(np.intersect1d(a, b, assume_unique=True)) >= need

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [linked(x.as_py(), y.as_py()) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["u", "v"])
    return run


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids


def _possible(na: Column, nb: Column, pa_: Column, pb: Column, apart: Column, share: tuple[int, int]) -> Column:
    """The length, positional and suffix filters for sets that share a shingle at positions pa_ and pb.

    If it is the first one shared, none before it is.  The parity signatures
    (``apart`` of their bits differ) bound how many shingles are in only one
    of the whole sets.
    """
    num, den = share
    need = _least_shared(na + nb, share)
    return ((F.least(na, nb) * den >= F.greatest(na, nb) * num) & (F.least(na - pa_, nb - pb) >= need) & (apart <= na + nb - 2 * need))


def _links(pairs: DataFrame, texts: DataFrame, sets: DataFrame, words: int, share: tuple[int, int], name: str) -> DataFrame:
    """The pairs (u, v) of ``pairs`` (a, b) that are similar enough by their whole sets."""
    ids = landed(pairs.select(F.explode(F.array("a", "b")).alias("at")).distinct(), f"{name}-ids")
    wanted = landed(sets.select("rid", "content").join(_few(ids), F.col("rid") == F.col("at"), "left_semi"), f"{name}-wanted")
    # copies of a text are merged before their shuffle and after it
    own = texts.join(_few(wanted.select(F.col("content").alias("c"))), F.col("content") == F.col("c"), "left_semi").distinct()
    whole = landed(own.mapInArrow(_whole(words), "of binary, shingles binary").join(wanted, F.col("of") == F.col("content"))
                   .select("rid", "shingles"), f"{name}-sets")
    side = lambda x: whole.select(F.col("rid").alias(f"c{x}"), F.col("shingles").alias(f"set_{x}"))
    both = pairs.join(side("b"), F.col("b") == F.col("cb")).join(side("a"), F.col("a") == F.col("ca"))
    return landed(both.select("a", "b", "set_a", "set_b").mapInArrow(_verify(share), "u long, v long"), f"{name}-links")


def _content(text: Column) -> Column:
    """128 bits of a text's SHA-256: what texts are told apart by."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _grouped(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """doc_id, n, component_id, x and g (a number of each component, null without shingles) for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = rows.filter("text is not null").select(_content(F.col("text")).alias("content"), "text")
    sets = landed(texts.distinct().mapInArrow(_sets(words), _SET).filter("n > 0").withColumn("rid", F.monotonically_increasing_id()), "sets")
    by_set = sets.groupBy("digest").agg(F.min("rid").alias("c"))
    of_text = landed(sets.select("digest", "content", "n").join(by_set, "digest").select("content", "c", "n"), "classes")
    facts = sets.select(F.col("rid").alias("k"), F.col("size").alias("kn"), *_SIGNATURE)

    total = sets.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    parts = sets.select("block", "shingles").mapInArrow(_by_shard(shards), "block long, shard int, shingles binary, seen binary")
    counts = landed(parts.groupBy("shard").applyInArrow(_counted, "of long, common binary, times binary"), "frequencies")
    first = landed(of_text.select("c").distinct(), "first")
    prefix = (sets.select("block", F.col("rid").alias("c"), "shingles").groupBy("block").cogroup(counts.groupBy("of"))
              .applyInArrow(_prefixes(share), "token long, c long, pos int, n long"))
    prefix = landed(prefix.join(first.select(F.col("c").alias("f")), F.col("c") == F.col("f"), "left_semi"), "prefix")

    common = (prefix.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min_by("c", "pos").alias("rep"), F.min("pos").alias("rep_pos"))
              .filter("lo <> hi").select(F.col("token").alias("t"), "rep", "rep_pos"))
    shared = landed(prefix.join(common, F.col("token") == F.col("t")).join(facts, F.col("c") == F.col("k"))
                    .select("token", "c", "pos", "n", "rep", "rep_pos", *_SIGNATURE), "shared")

    apart = lambda a, b: sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in _SIGNATURE), F.lit(0))
    pair = [F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b")]
    met = lambda a, b: _possible(F.col("x.n"), F.col("y.n"), F.col(a), F.col(b), apart("x", "y"), share)
    reps = facts.select(F.col("k").alias("c"), F.col("kn").alias("n"), *_SIGNATURE)
    star = (shared.filter("c <> rep").alias("x").join(reps.alias("y"), F.col("x.rep") == F.col("y.c"))
            .filter(met("x.pos", "x.rep_pos")).select(*pair).distinct())
    star = landed(star, "star-pairs")
    links = _links(star, texts, sets, words, share, "star")
    vertices = shared.select(F.col("c").alias("id")).distinct()
    group = landed(connected_components(vertices, links), "groups")

    near = landed(shared.drop("rep", "rep_pos").join(group.select("id", F.col("component_id").alias("g")), F.col("c") == F.col("id")).drop("id"), "grouped")
    mixed = near.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo <> hi").select("token")
    near = landed(near.join(mixed, "token", "left_semi"), "mixed")
    across = (near.alias("x").join(near.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c"))
                                   & (F.col("x.g") != F.col("y.g")) & met("x.pos", "y.pos")).select(*pair).distinct())
    # a pair that the star has rejected is in two components still, and not looked at again
    across = landed(across.join(star, ["a", "b"], "left_anti"), "across-pairs")
    more = _links(across, texts, sets, words, share, "across")
    group = connected_components(vertices, links.unionByName(more))

    named = landed(of_text.select("content", "c", "n").join(group, F.col("c") == F.col("id"), "left")
                   .select(F.col("content").alias("of"), "n", F.coalesce("component_id", "c").alias("g")), "named")
    members = rows.select("doc_id", F.xxhash64("text").alias("x"), _content(F.col("text")).alias("content"))
    members = landed(members.join(named, F.col("content") == F.col("of"), "left").select("doc_id", "x", "n", "g"), "members")
    least = landed(members.filter("g is not null").groupBy("g").agg(F.min("doc_id").alias("component_id")).select(F.col("g").alias("at"), "component_id"), "least")
    out = members.join(least, F.col("g") == F.col("at"), "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                      F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "x", "g")


def ngram_components(docs: DataFrame, words: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, n_shingles, component_id and x (hash of the text) for every row of ``docs`` (doc_id, text).

    Documents link when the Jaccard similarity of their sets of ``words``-word
    shingles (see ``shingle_sets``) is at least ``share``; components are exact.

    1. Copies of a text are merged, then equal sets (128-bit digests of whole
       sets) form a class; classes, not copies, are compared.
    2. Every shingle is counted over all distinct texts: blocks of documents
       hand their distinct shingles (40 bits of each hash) to ranges of hashes
       and get back the numbers of those that more than one text has.
    3. A class's prefix holds its rarest shingles, of which a linked set must
       have one.  Those that no other text has take their places in it but
       need no row, so only texts that are near copies in most parts have
       any.  A shingle common to many texts stands last and is in a prefix
       only where little else is.
    4. First every class meets, per prefix shingle, only the class that has
       it earliest, the one with fewest rarer shingles of its own.  Length,
       positional and suffix filters thin the pairs, each left is verified
       once on whole sets of 64-bit hashes, and links are merged into
       components.
    5. Then only pairs in different components that share a prefix shingle
       remain, without those rejected before; they go through the same
       filters and verification.  Pairs inside a component need not be looked
       at, so a group of near copies costs a star, not its square, and no
       link between components is lost.

    Null, empty and blank texts have n_shingles 0 and link with nothing.
    Repeated rows and ids stay; a null doc_id stays null and is no
    component's smallest id (a component without ids has a null id).  Other
    columns are ignored; an empty table gives an empty one.
    """
    found = _grouped(docs, words, share)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "x")


def keep_one(docs: DataFrame, words: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Rows that share a doc_id but are in different components are different
    documents, and each component keeps its own.  In a component, rows of the
    smallest doc_id whose texts differ are told apart by xxhash64 of the
    text, the smallest stays; rows that repeat doc_id and text are one
    document, of which one row stays.  Rows without an id come last.  Rows
    without shingles (null, empty and blank texts) all stay.  Few rows to
    drop are broadcast after counting them, more are joined by a shuffle,
    which no id can dominate.
    """
    found = landed(_grouped(docs, words, share).filter("g is not null").select("doc_id", "x", "g"), "components")
    own = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("d"), F.col("x").alias("x"))
    best = landed(found.groupBy("g").agg(F.min(own).alias("best")).select(F.col("g").alias("of"), "best"), "best")
    lost = found.join(best, F.col("g") == F.col("of")).filter(own != F.col("best")).select("doc_id", "x")
    lost = landed(lost.distinct(), "lost")
    mine = (F.xxhash64("d.text") == F.col("l.x")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col("l.doc_id"))
    out = docs.alias("d").join(_few(lost).alias("l"), mine, "left_anti")
    many = landed(found.groupBy("doc_id", "x").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "x"), "repeated")
    if not many.limit(1).count():
        return out
    once = out.alias("d").join(_few(many).alias("l"), mine, "left_semi").dropDuplicates(["doc_id", "text"])
    return out.alias("d").join(_few(many).alias("l"), mine, "left_anti").unionByName(once)


NGRAM_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                                 ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN sizes x ON u = x.doc_id JOIN sizes y ON v = y.doc_id WHERE 100 * i >= 85 * (x.n + y.n - i)),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reached(doc_id, top) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.v FROM reached r JOIN both_ways e ON r.top = e.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes n ON d.doc_id = n.doc_id
JOIN (SELECT doc_id, min(top) AS component_id FROM reached GROUP BY doc_id) c ON d.doc_id = c.doc_id
"""
