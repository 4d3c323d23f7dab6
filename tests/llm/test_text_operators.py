"""Line dedup, fingerprints, mixing and secrets against brute force."""

import hashlib
import math
import re
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from stopflow.llm import line_dedup as ld
from stopflow.llm.fingerprint import containment, edited_fingerprints, jaccard, merge, sketch
from stopflow.llm.mixing import mix_sources, source_rates
from stopflow.llm.queries import ORACLE, QUERIES
from stopflow.llm.secret_scan import RULES, find_spans, read_ledger, scan_versions, span_digests

from .conftest import SCHEMA, SMALL, edge_rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    got = QUERIES[name](spark, SMALL)
    cols = sorted(got.columns)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    rows = [tuple(r[names.index(c)] for c in cols) for r in want.fetchall()]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in got.select(*cols).collect())


def lines_of(text):
    return [x for x in re.split(r"(?<=\n)|(?<=[.!?] )", text) if x]


def test_split_lines(spark):
    """The plain replacements cut where the regular expression does, marks in the text included."""
    texts = ["", None, "\n", "a. b! c? d.e\nf\n\n", "a. \nb", "...  ?! ", "mark \1 a. b\n\1", ". \1. ", "é. 日本\n\U0001f600! x", *(r[1] for r in edge_rows())]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = {r.k: r.ls for r in df.select("k", ld.split_lines(F.col("text")).alias("ls")).collect()}
    assert [got[k] for k in range(len(texts))] == [None if t is None else lines_of(t) for t in texts]


def brute_dedup(rows):
    """Texts after removal, by (doc_id, text) in the order of rows."""
    seen = {}
    keyed = {(2**63 - 1 if i is None else i, t) for i, t in rows if t is not None}
    found = []
    for i, t in keyed:
        ls = lines_of(t)
        hs = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in ls]
        for a, b in ld.ROLLS:
            start = 0
            for k, h in enumerate(hs):
                if (h * a + (hs[k - 1] if k else 0) * b) % ld.PRIME % ld.DIVISOR == 0 or k == len(hs) - 1:
                    if k - start >= 1:
                        found.append(((i, t), start, k + 1, tuple(ls[start:k + 1])))
                        seen[tuple(ls[start:k + 1])] = min(seen.get(tuple(ls[start:k + 1]), (i, start)), (i, start))
                    start = k + 1
    gone = {}
    for key, s, e, chunk in found:
        if (key[0], s) > seen[chunk]:
            gone.setdefault(key, set()).update(range(s, e))
    return [None if t is None else "".join(x for k, x in enumerate(lines_of(t)) if k not in gone.get((2**63 - 1 if i is None else i, t), ()))
            for i, t in rows]


def test_dedup_edges(clashing, none):
    rows = edge_rows()
    want = brute_dedup([(r[0], r[1]) for r in rows])
    got = ld.dedup_lines(clashing)
    assert got.columns == [c for c in clashing.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    got = got.collect()
    assert sorted((str(r[0]), str(t)) for r, t in zip(rows, want, strict=True)) == sorted((str(r.doc_id), str(r.text)) for r in got)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.c == "theirs" for r in got)
    assert sum(r.n_removed for r in got) > 0 and all(r.n_lines >= 0 for r in got)
    assert ld.dedup_lines(none).collect() == []


def test_dedup_shifted_passage(spark):
    """A passage of over 50 words inside otherwise different documents loses its copies' inside."""
    passage = " ".join(f"Passage sentence number {w} holds some words." for w in "one two three four five six seven eight nine ten".split())
    docs = [(i, f"Document {i} starts so. " * (i + 1) + passage + f" And ends {i} here. " + "\n".join(f"Line {i} {k}." for k in range(i + 2)), "en", "s", 1)
            for i in range(6)]
    got = {r.doc_id: r for r in ld.dedup_lines(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert passage in got[0].text
    assert all(passage not in got[i].text and got[i].n_removed >= 2 for i in range(1, 6))
    # what only one document has stays
    assert all(f"And ends {i} here." in got[i].text and f"Line {i} 0." in got[i].text for i in range(6))


def test_hash_collision_removes_nothing(spark, monkeypatch):
    """Chunks that share a hash but not their bytes stay."""
    monkeypatch.setattr(ld.F, "xxhash64", lambda *c: F.lit(7).cast("long") if not c or not isinstance(c[0], str) else F.crc32(c[0]))
    docs = [(1, "A b. C d. E f. G h. I j. K l.", "en", "s", 1), (2, "M n. O p. Q r. S t. U v. W x.", "en", "s", 1)]
    got = ld.dedup_lines(spark.createDataFrame(docs, SCHEMA)).collect()
    assert all(r.n_removed == 0 for r in got)


def brute_whole(rows):
    """Texts without repeated passages of two or more lines, by (doc_id, text) in the order of rows."""
    number = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for i, t in rows:
        ls = lines_of(t or "")
        for s in range(len(ls) - 1):
            first[ls[s], ls[s + 1]] = min(first.get((ls[s], ls[s + 1]), math.inf), number(i) * 2**31 + s)
    out = []
    for i, t in rows:
        ls = lines_of(t or "")
        gone = {k for s in range(len(ls) - 1) if number(i) * 2**31 + s >= first[ls[s], ls[s + 1]] + 2 for k in (s, s + 1)}
        out.append(None if t is None else "".join(x for k, x in enumerate(ls) if k not in gone))
    return out


def test_whole_passages_edges(clashing, none):
    rows = edge_rows()
    want = brute_whole([(r[0], r[1]) for r in rows])
    got = ld.dedup_lines(clashing, whole=True).collect()
    assert sorted((str(r[0]), str(t)) for r, t in zip(rows, want, strict=True)) == sorted((str(r.doc_id), str(r.text)) for r in got)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.c == "theirs" for r in got)
    assert ld.dedup_lines(none, whole=True).collect() == []


def test_whole_passages(spark):
    """Passages of 2 to 10 lines go wholly from their copies, whatever stands beside them; nothing else goes."""
    docs, want = [], {}
    for n in (2, 3, 4, 5, 10):
        passage = "".join(f"Line {k} of the passage of {n} lines.\n" for k in range(n))
        for copy in range(8):
            i = len(docs)
            before = "".join(f"Before {i} {k}.\n" for k in range(copy % 4))
            after = "".join(f"After {i} {k}.\n" for k in range(copy // 4))
            docs.append((i, before + passage + after, "en", "s", 1))
            want[i] = before + (passage if copy == 0 else "") + after
    docs.append((len(docs), "Again and again. " * 5, "en", "s", 1))
    want[len(docs) - 1] = "Again and again. " * 2
    got = {r.doc_id: r.text for r in ld.dedup_lines(spark.createDataFrame(docs, SCHEMA), whole=True).collect()}
    assert got == want


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def share(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op3_fingerprints"](spark, SMALL).collect()}
    order = sorted(texts, reverse=True)
    off = []
    for k, i in enumerate(order):
        t, after = texts[i], texts[order[(k + 1) % len(order)]]
        n = len(t) // 3
        edited = t[:len(t) - n] + after[:n]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off += [got[i].near_edited - share(shingles(t), shingles(edited)), got[i].near_next - share(shingles(t), shingles(after))]
    assert statistics.mean(map(abs, off)) < 0.04 and max(map(abs, off)) < 0.25
    by_text = {}
    for i, t in texts.items():
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint


def test_fingerprint_edges(clashing, none, spark):
    rows = {r[0]: r[1] or "" for r in edge_rows() if r[0] is not None}
    got = {r.doc_id: r for r in edited_fingerprints(clashing).collect()}
    assert got.keys() == rows.keys()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert got[4].n_chars == 0 and got[1].fingerprint == got[2].fingerprint and got[2].near_next > 0.99
    assert edited_fingerprints(none).collect() == []
    one = edited_fingerprints(spark.createDataFrame([(5, "abc def", "en", "s", 7)], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abc dab").hexdigest() and one[0].near_next == 1


def test_sketch_merge_and_containment(spark):
    words = [f"w{i}" for i in range(4000)]
    small, large = " ".join(words[500:1500]), " ".join(words)
    df = spark.createDataFrame([(small, large, " ".join(words[1496:]))], "a string, b string, c string")
    s = {c: sketch(F.col(c)) for c in "abc"}
    row = df.select(containment(s["a"], s["b"]).alias("ab"), containment(s["b"], s["a"]).alias("ba"),
                    jaccard(merge(s["a"], s["c"]), s["b"]).alias("m")).first()
    assert row.ab == 1 and abs(row.ba - 996 / 3996) < 0.1 and abs(row.m - 3500 / 3996) < 0.1


def test_mix_weights(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("ab cd").alias("text"), F.lit("en").alias("lang"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"),
                                    F.lit(5).cast("long").alias("n_chars"))
    weights = {"hot": 0.1, "s0": 0.2, "s1": 0.7}
    got = {r.source: r.n for r in mix_sources(docs, weights).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert got.keys() == weights.keys()
    for s, w in weights.items():
        assert abs(got[s] - 6000 * w) < 5 * (6000 * w) ** 0.5
    # rates beyond one draw
    big = mix_sources(docs.limit(4).withColumn("source", F.lit("s")), epochs=200.0)
    assert abs(big.count() - 800) < 150


def test_mix_zero_weights(spark, clashing):
    """Weights that leave nothing give no rows but those of sources without text; negative ones are refused."""
    for weights in ({"zz": 1.0}, {}, {"s1": 0.0}):
        rates = {r.source: r.rate for r in source_rates(clashing, weights).collect()}
        assert set(rates.values()) == {0.0}
        assert mix_sources(clashing, weights).collect() == []
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3), (2, "", "en", "t", 0)], SCHEMA)
    assert {r.doc_id for r in mix_sources(docs, {"zz": 1.0}, epochs=30.0).collect()} == {2}
    with pytest.raises(ValueError, match="negative"):
        source_rates(docs, {"s": -1.0})


def test_mix_without_ids(spark):
    """Rows without an id draw counts of their own, so weights hold for them too."""
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.format_string("%05d", "id")).alias("text"),
                                    F.lit("en").alias("lang"), F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    got = {r.source: r.n for r in mix_sources(docs, {"s0": 0.25, "s1": 0.75}).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(got["s0"] - 1000) < 5 * 1000**0.5 and abs(got["s1"] - 3000) < 5 * 3000**0.5


def test_mix_edges(clashing, none):
    a, b = mix_sources(clashing).collect(), mix_sources(clashing.repartition(7)).collect()
    assert [r.shuffle_key for r in a] == sorted(r.shuffle_key for r in a)
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert {r.copy for r in a} >= {0} and all(r.h == "theirs" for r in a)
    assert {str(r.source) for r in source_rates(clashing).collect()} == {"s1", "s2", "s3", "s9", "None"}
    assert mix_sources(none).collect() == []


BASE = ((0, re.compile(RULES[0][1], re.I | re.A), 2, 8), (1, re.compile("AKIA[A-Z0-9]+"), 0, 16), (2, re.compile("[0-9a-f]+"), 0, 32))


def brute_spans(text):
    return sorted((m.start(), k, m.end()) for k, rx, group, least in BASE for m in rx.finditer(text) if len(m[group]) >= least)


def test_secrets(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op7_secret_scan"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        spans = brute_spans(t)
        joined = ",".join(f"{RULES[k][0]}:{s}:{e}" for s, k, e in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]


@pytest.mark.parametrize("text", ["", "token: api_key=abcdefgh", "secret: token: abcdefghijk", "PassWord\"  =  'a.b/c+d=e", "ſecret=abcdefghi",
                                  "AKIAAKIA1234567890 AKIA12 xAKIA123456789012", "0" * 31 + "g" + "a" * 32, "é😀 apikey=12345678"])
def test_spans(text):
    assert [s for s in find_spans(text) if s[1] < 3] == brute_spans(text)


def test_ledger_is_incremental(spark, edge, clashing, none, tmp_dir):
    path = f"{tmp_dir}/ledger"
    assert read_ledger(spark, path) is None
    found = scan_versions(clashing, path)
    rows = found.collect()
    assert len(rows) == len(edge_rows()) and all(r.rank == "theirs" for r in rows)
    digest = {r.doc_id: r for r in span_digests(found.select("doc_id", "kinds", "starts", "ends")).collect()}
    assert [digest[13].n_assign, digest[13].n_access, digest[13].n_hex] == [1, 1, 1]
    blobs = len({r[1] or "" for r in edge_rows()})
    assert read_ledger(spark, path).count() == blobs
    scan_versions(edge, path).collect()  # nothing unseen
    assert read_ledger(spark, path).count() == blobs
    scan_versions(edge.filter("doc_id < 4"), path, rule_version="next").collect()
    assert read_ledger(spark, path).count() == blobs + 3
    assert scan_versions(none, path).collect() == []
