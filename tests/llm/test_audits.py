"""Hard negatives, benchmark decontamination and the filter audit against brute force."""

import random
from collections import defaultdict
from hashlib import sha256
from itertools import permutations

import duckdb
import numpy as np
import pytest

from stopflow.llm import decontaminate as dc
from stopflow.llm import filter_audit as fa
from stopflow.llm import hard_negatives as hn

from .conftest import CLASH, SMALL, edge_rows


# --- hard negatives


def brute_negatives(rows):
    """Rows (vec_id, label, components) to the result's rows."""
    kept = {}
    for i, label, x in rows:
        if i is None or label is None or not x or any(c is None or not np.isfinite(c) for c in x):
            continue
        v = [int(np.floor(256 * float(c))) for c in x]
        kept[i] = min(kept.get(i, (str(label), v)), (str(label), v))
    out = []
    for a in (i for i in kept if i % 50 == 0):
        label, v = kept[a]
        met = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), i, other) for i, (other, w) in kept.items() if i != a and len(w) == len(v))
        for ps, p, _ in [m for m in met if m[2] == label][:5]:
            fit = [(i, -s) for s, i, other in met if other != label and 50 * -ps <= 100 * -s <= 95 * -ps][:3]
            out += [(a, p, k + 1, i, -ps, s) for k, (i, s) in enumerate(fit)]
    return sorted(out)


def as_table(spark, rows):
    return spark.createDataFrame([(i, x, c) for i, c, x in rows], "vec_id long, embedding array<double>, label int")


def test_hard_negatives_blocks(spark, monkeypatch):
    """Several blocks of rows and anchors, one label with most rows, copies, ties and negative scores."""
    monkeypatch.setattr(hn, "BLOCK", 64)
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(4, 24)) / 5
    rows = [(i, int(rng.choice([0, 0, 0, 1, 2, 3])), (middle[i % 4] + rng.normal(size=24) / 8).tolist()) for i in range(0, 3000, 5)]
    rows += [(i + 1, c, x) for i, c, x in rows[:150]]
    got = hn.hard_negatives(as_table(spark, rows)).collect()
    want = brute_negatives(rows)
    assert sorted(map(tuple, got)) == want and len(want) > 300


def test_hard_negative_edges(spark):
    rng = np.random.default_rng(3)
    vec = lambda n=8: rng.normal(size=n).tolist()
    rows = [(i, i % 3, vec()) for i in range(0, 200, 2)] + [(i, i % 2, vec(5)) for i in range(1000, 1100, 10)]
    rows += [(50, 1, vec()), (150, None, vec()), (None, 1, vec()), (250, 1, None), (300, 1, []), (350, 1, [None] * 8), (51, 1, [float("nan")] * 8),
             (53, 2, [float("inf")] * 8), (400, 0, [0.0] * 8), (-50, 1, vec()), rows[0], rows[0]]
    table = as_table(spark, rows)
    for c in ("rank", "goal", "dim", "v", "r", "anchor", "score"):
        table = table.withColumn(c, table.vec_id)
    assert sorted(map(tuple, hn.hard_negatives(table).collect())) == brute_negatives(rows)
    # components beyond the bound, and norms beyond it
    large = [(0, 1, [1e300, 0.0]), (50, 1, [2.0**21] * 40)]
    assert hn.hard_negatives(as_table(spark, large)).collect() == []
    assert hn.hard_negatives(as_table(spark, [])).collect() == []
    assert hn.hard_negatives(as_table(spark, rows[:1])).collect() == []


@pytest.mark.parametrize("dim", [1, 3, 64, 100, 300])
def test_intervals_hold(dim):
    """The interval of every pair holds its score, and is narrow enough to drop most rows."""
    rng = np.random.default_rng(dim)
    x, q = (np.floor(rng.normal(size=(n, dim)) * 10.0 ** rng.integers(0, 6, size=(n, 1))).astype(np.int64) for n in (200, 30))
    x[0], q[0] = 0, 0
    norms = np.sqrt((x.astype(float) ** 2).sum(1))
    low, high = hn.intervals(q, *hn.encode(x), norms)
    exact = q @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    scale = np.outer(np.sqrt((q.astype(float) ** 2).sum(1)), norms)
    assert np.median((high - low)[scale > 0] / scale[scale > 0]) < 0.25  # 2 without codes


# --- decontamination


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute_contamination(docs, items, window=10):
    """(doc_id, n_words, n_hit, n_items, hash, flag, spans) of each document (doc_id, text)."""
    windows = defaultdict(set)
    for i, text in items:
        ws = words_of(text)
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if ws else 0):
            windows[tuple(ws[k:k + n])].add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        ws = words_of(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(ws) - n + 1):
                got = windows.get(tuple(ws[k:k + n]))
                if got:
                    hit |= set(range(k, k + n))
                    found |= got
        edges = sorted(k for k in hit if k - 1 not in hit)
        spans = [(k, next(e for e in range(k, len(ws) + 1) if e not in hit)) for k in edges]
        out.append((i, len(ws), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), spans))
    return out


def check_contamination(spark, docs, items, bench=None, table=None, window=10):
    bench = bench if bench is not None else spark.createDataFrame(items, "item_id long, text string")
    table = table if table is not None else spark.createDataFrame(docs, "doc_id long, text string")
    got = [(*r[:6], [tuple(s) for s in r.spans]) for r in dc.contamination(table, bench, window).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_contamination(docs, items, window)))
    return got


def test_every_shared_window_is_found(spark):
    """Spans of just the window's length and longer, at text ends, with case and other breaks, and one word short of it."""
    rnd = random.Random(4)
    pool = [f"w{i}" for i in range(30)]  # few words, so parts of windows meet often
    some = lambda n: [rnd.choice(pool) for _ in range(n)]
    items = [(i, " ".join(some(rnd.choice([10, 11, 15, 40])))) for i in range(60)] + [(100, "Ünï " * 12), (101, "same " * 30)]
    docs = []
    for k in range(300):
        ws = words_of(rnd.choice(items)[1])
        n = rnd.choice([8, 9, 10, 10, 11, 20])
        at = rnd.randrange(max(1, len(ws) - n + 1))
        text = [*some(rnd.randrange(12)), *ws[at:at + n], *some(rnd.randrange(12))]
        docs.append((k, rnd.choice([" ", ", ", "\n", "--"]).join(w.upper() if rnd.random() < 0.3 and w.isascii() else w for w in text)))
    got = check_contamination(spark, docs, items)
    assert 100 < sum(r[5] for r in got) < 300


@pytest.mark.parametrize("window", [1, 2, 10, 13])
def test_short_items(spark, window):
    """Items shorter than the window are windows of their own lengths."""
    rnd = random.Random(window)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(14)] + [(50, "a"), (51, "a b"), (None, "no id b a"), (50, "second text"), (60, None), (61, " ,.")]
    docs = [(n, " ".join(rnd.choice("abcd") for _ in range(n))) for n in range(20)]
    docs += [(100 + n, "start " + " ".join(f"i{n}x{k}" for k in range(n)) + " end") for n in range(14)]
    check_contamination(spark, docs, items, window=window)


def test_contamination_edges(spark, clashing, none):
    from pyspark.sql import functions as F

    docs = [(r[0], r[1]) for r in edge_rows()]
    items = [(1, docs[0][1]), (2, " ".join(words_of(docs[8][1])[700:760])), (3, "lone words"), (3, docs[7][1]), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    clash = bench.withColumns({c: F.lit(1) for c in ("words", "item", "ws", "shown", *CLASH)})
    got = check_contamination(spark, docs, items, clash, clashing)
    assert any(r[5] for r in got)
    assert dc.contamination(none, bench).collect() == []
    assert not any(r.contaminated for r in dc.contamination(clashing, bench.limit(0)).collect())


def test_contamination_shuffled(spark, monkeypatch, texts):
    """Benchmark tables too large to broadcast give the same rows."""
    monkeypatch.setattr(dc, "MOST_BROADCAST_BYTES", 0)
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    got = check_contamination(spark, list(texts.items()), items)
    assert any(r[5] for r in got)


# --- filter audit


def failed(text):
    ws = (text or "").encode().split()
    text = text or ""
    return {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text)}


def brute_audit(docs, labels):
    """Every order applied document by document; docs (doc_id, text, lang), labels (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        first[t or ""] = min(first.get(t or "", 2**63 - 1), 2**63 - 1 if i is None else i)
    out = []
    parts = defaultdict(list)
    for i, t, lang in docs:
        f = failed(t) | {"E": first[t or ""] < (2**63 - 1 if i is None else i)}
        mine = [r for r in labels if r[0] is not None and r[0] == i]
        parts[lang or ""].append((f, any(r[1] == 1 for r in mine), any(r[2] == 1 for r in mine)))
    for part, rows in parts.items():
        steps = []
        for order in permutations("ABCDE"):
            left = list(rows)
            for s, x in enumerate(order, 1):
                gone = [r for r in left if r[0][x]]
                left = [r for r in left if not r[0][x]]
                steps.append((part, "".join(order), s, len(left), len(gone), sum(r[0][x] for r in rows) - len(gone),
                              sum(r[0][x] and sum(r[0].values()) == 1 for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone), x))
        shapley = defaultdict(int)
        for s in steps:
            shapley[s[-1]] += s[4]
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def test_audit_edges(spark, clashing, none):
    rnd = random.Random(1)
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, 1), (9, 1, 0), (None, 1, 1), (77, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = [(r[0], r[1], r[2]) for r in edge_rows()]
    got = fa.filter_audit(clashing, table.withColumn("part", table.quality))
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)
    assert fa.filter_audit(none, table).collect() == []
    # every set of failed filters, copies in other languages, and a part of its own for null and empty
    more = []
    for i in range(300):
        ws = [f"w{rnd.randrange(rnd.choice([5, 1000]))}" for _ in range(rnd.choice([0, 1, 50, 99, 100, 101, 300]))]
        text = rnd.choice([" ", "\n", "\t \x0b"]).join(w.upper() if rnd.random() < rnd.choice([0, 0, 0.5]) else w for w in ws)
        more.append((i, text + rnd.choice(["", "", " #", "|", "é"]), rnd.choice(["en", "de", None, ""])))
    more += [(300 + i, t, "fr") for i, t, _ in more[:40]] + [(i, t, "en") for i, t, _ in more[:5]] + [(None, more[0][1], "en"), (None, "x", "en")]
    docs2 = spark.createDataFrame(more, "doc_id long, text string, lang string").repartition(5)
    assert sorted(map(tuple, fa.filter_audit(docs2, table.limit(0)).collect())) == brute_audit(more, [])


def brute_measure(text):
    ws = text.encode().split()
    return [len(ws), len(set(ws)), sum("A" <= c <= "Z" for c in text), sum(c in "#$%&*|" for c in text), len(text)]


def measured(texts):
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(x) for x in data]).astype(np.int64)
    return fa.measure(np.frombuffer(b"".join(data), np.uint8), ends - [len(x) for x in data], ends).tolist()


@pytest.mark.parametrize("slab", [16, 100, 1 << 22])
def test_transducer(monkeypatch, slab):
    """Texts around the size of a slab, words over its border, words longer than it, code points of all lengths."""
    monkeypatch.setattr(fa, "SLAB", slab)
    monkeypatch.setattr(fa, "LONG", 40)
    rnd = random.Random(slab)
    letters = "aB#|é日\U0001f600 \n\x0b\xa0 "
    texts = ["", " ", "a", "a" * 500, "A b " * 200, "\U0001f600" * 60, "x" * 39 + " " + "x" * 40 + " " + "x" * 40, " lead", "trail "]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(300))) for _ in range(300)]
    assert measured(texts) == [brute_measure(t) for t in texts]


def test_hash_table_compares_bytes(monkeypatch):
    """With one hash for all words the table still tells them apart."""
    monkeypatch.setattr(fa, "_hashes", lambda eights, start, size, owner: np.zeros(len(start), np.uint64))
    texts = ["one two one abcdefgh abcdefgi abcdefghi abcdefghj", "one two", ""]
    assert measured(texts) == [brute_measure(t) for t in texts]
