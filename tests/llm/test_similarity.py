"""Embedding near-dedup and the n-gram join against brute force."""

import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from stopflow.llm import embed_dedup as ed
from stopflow.llm import ngram_join as nj
from stopflow.llm import spans as sp
from stopflow.llm.common import connected_components
from stopflow.llm.queries import QUERIES

from .conftest import SCHEMA, SMALL, components, edge_rows


def test_components(spark):
    rnd = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(200, 260)]
    some = [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    links = [*chain, *hub, *some, (1, 1), (500, 2), (500, 3)]
    ids = range(600)
    got = connected_components(spark.range(600), spark.createDataFrame(links, "u long, v long"))
    assert {r.id: r.component_id for r in got.collect()} == components(ids, links)
    assert connected_components(spark.range(2), spark.createDataFrame([], "u long, v long")).count() == 2


def sets_of(rows, words):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append({tuple(w)} if 0 < len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)})
    return out


def brute_join(rows, words, share):
    """Set sizes, and components by row number."""
    sets, (num, den) = sets_of(rows, words), share
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    return [len(s) for s in sets], components(range(len(rows)), links)


def check_join(got, rows, words, share):
    sizes, comp = brute_join(rows, words, share)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[comp[k]] = min(least.get(comp[k], i), i)
    want = [(i, n, least.get(comp[k]) if n else i) for k, ((i, _), n) in enumerate(zip(rows, sizes, strict=True))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(want, key=key)


def test_ngram_join(spark, texts):
    check_join(QUERIES["op5_ngram_join"](spark, SMALL).collect(), list(texts.items()), 4, (85, 100))


def edited_copies(n, edits, seed=3, length=60):
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(length)] = f"e{k}x{rnd.random()}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("words,share", [(4, (85, 100)), (5, (4, 5)), (1, (1, 2)), (3, (1, 1))])
def test_ngram_join_near_copies(spark, words, share):
    """A large group of near copies around the threshold, short texts, and exact copies in other case."""
    rnd = random.Random(words)
    texts = edited_copies(60, 4) + edited_copies(25, 2, seed=8, length=12) + edited_copies(10, 1)
    texts += [" ".join(f"s{rnd.randrange(9)}" for _ in range(rnd.randrange(9))) for _ in range(60)] + [texts[0].upper(), None, " \n"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_join(nj.ngram_components(docs, words, share).collect(), rows, words, share)


def test_ngram_join_edges(clashing, none):
    rows = [(r[0], r[1]) for r in edge_rows()]
    check_join(nj.ngram_components(clashing).collect(), rows, 5, (4, 5))
    assert nj.ngram_components(none).collect() == []


def test_keep_one(clashing, none):
    got = nj.keep_one(clashing)
    assert got.columns == clashing.columns
    ids = sorted(str(r.doc_id) for r in got.collect())
    # 1, 2, 11, 12 share a text, 8 holds it beside another; 3 comes with two texts, one of them also without an id
    assert ids == sorted(map(str, [1, 3, 3, 4, 5, 6, 7, 8, 9, 10, 13, None, None]))
    assert nj.keep_one(none).collect() == []


def test_keep_one_of_shared_ids(spark):
    """Rows of one id in several components are documents of their own; copies and near copies of them go."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, a), (2, c), (1, a + " end"), (None, c), (None, "no id"), (None, "no id"), (3, ""), (3, ""), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in nj.keep_one(docs).collect()]
    near = [r for r in got if r in ((1, a), (1, a + " end"))]
    assert len(near) == 1
    want = [near[0], (1, b), (2, c), (None, "no id"), (3, ""), (3, ""), (3, None)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_candidates_grow_with_the_input(spark, monkeypatch):
    """Texts of a common passage and their own words, some with a near copy: five times the texts, five times the pairs looked at."""
    landed, seen = nj.landed, {}

    def counted(df, name):
        out = landed(df, name)
        seen[name] = seen.get(name, 0) + (out.count() if name.endswith("-pairs") else 0)
        return out
    monkeypatch.setattr(nj, "landed", counted)

    def pairs(n):
        rnd = random.Random(n)
        passages = [[f"p{k}x{i}" for i in range(40)] for k in range(3)]
        texts = []
        for k in range(n):
            w = [*rnd.choice(passages), *(f"u{k}x{i}" for i in range(60)), *rnd.choice(passages)]
            texts.append(" ".join(w))
            if k % 4 == 0:
                texts.append(" ".join([*w[:50], "edit", *w[50:]]))
        seen.clear()
        rows = list(enumerate(texts))
        check_join(nj.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows, 5, (4, 5))
        return sum(seen.values())
    small, large = pairs(40), pairs(200)
    assert small >= 10 and large <= 5 * small + 10


@pytest.mark.parametrize("slab", [8, 64, 4 << 20])
def test_shingle_sets(monkeypatch, slab):
    """As many distinct shingles as by brute force, equal for equal ones, whatever stands beside a text."""
    monkeypatch.setattr(sp, "SLAB", slab)
    monkeypatch.setattr(sp, "LONG", 20)
    rnd = random.Random(slab)
    texts = ["", None, " \n", "one", "ONE", "\u00c9 \u00e9", "x" * 300, "a " * 100] + [
        "".join(rnd.choice("aAbB\u00e9\U0001f600 \n\x0b\xa0") for _ in range(rnd.randrange(200))) for _ in range(200)]
    texts += [t and t.upper() if (t or "").isascii() else t for t in texts]
    got = [frozenset(s.tolist()) for s in nj.shingle_sets(pa.array(texts, pa.string()), 3)]
    want = [frozenset(s) for s in sets_of(list(enumerate(texts)), 3)]
    assert [len(s) for s in got] == [len(s) for s in want]
    names = {}
    for g, w in zip(got, want, strict=True):
        assert names.setdefault(w, g) == g
    assert len(set(names.values())) == len(names)


def test_prefix_length():
    """No linked, different pair of sets can avoid the prefix."""
    for share in ((85, 100), (4, 5), (1, 2)):
        num, den = share
        for n in range(1, 200):
            p = nj._prefix_length(n, share)
            possible = any(den * min(n, m) >= num * max(n, m) for m in (n - 1, n + 1) if m > 0)
            assert (p > 0) == possible
            if p:  # with none of the prefix shared, too little is left
                assert den * (n - p) < num * n <= den * (n - p + 1)


def brute_links(ids, labels, vecs, threshold):
    x = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    near = (x @ x.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    return near


def check_vectors(got, ids, labels, vecs, exact=True):
    near = brute_links(ids, labels, vecs, 0.93)
    found = sum(got[i].n_links for i in ids)
    assert found <= near.sum() and found >= 0.9 * near.sum()
    assert all(got[i].n_links <= n for i, n in zip(ids, near.sum(1), strict=True))
    if exact:
        assert [got[i].n_links for i in ids] == near.sum(1).tolist()
        comp = components(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near), strict=True)])
        assert all(got[i].component_id == comp[i] and got[i].kept == (comp[i] == i) for i in ids.tolist())
    return found / max(1, near.sum())


def test_embeddings(spark):
    t = pq.read_table(f"{SMALL}/embeddings.parquet")
    got = {r.vec_id: r for r in QUERIES["op2_embedding_dedup"](spark, SMALL).collect()}
    assert len(got) == t.num_rows
    check_vectors(got, t["vec_id"].to_numpy(), t["label"].to_numpy(), np.stack(t["embedding"].to_pylist()).astype(float))


def test_embedding_recall_and_hot_cells(spark, monkeypatch):
    """Many near copies of one vector over several blocks, pairs, copies, and a fine grid."""
    monkeypatch.setattr(ed, "BLOCK", 64)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(500, 32))
    hot = base[0] + 0.18 * rng.normal(size=(300, 32))
    pairs = base[1:300] + 0.12 * rng.normal(size=(299, 32))
    vecs = np.concatenate([base, hot, pairs, base[300:340]]).astype(np.float32).astype(float)
    labels = np.concatenate([np.arange(500) % 3, np.zeros(300, int), np.arange(1, 300) % 3, np.arange(300, 340) % 3])
    ids = np.arange(len(vecs)) * 3 + 5
    rows = [(int(i), [float(c) for c in v], int(k)) for i, v, k in zip(ids, vecs, labels, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in ed.embedding_duplicates(df, cell_size=4).collect()}
    assert check_vectors(got, ids, labels, vecs, exact=False) >= 0.97


def rare_links(n, pairs, dim, cosine, seed=11):
    """Random unit vectors of which only the last ``pairs`` and the first as many link, each to one."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(pairs, dim))
    away -= (away * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    return np.concatenate([x, cosine * x[:pairs] + math.sqrt(1 - cosine ** 2) * away])


def found_share(spark, vecs, **more):
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in ed.embedding_duplicates(df, **more).collect()}
    return check_vectors(got, np.arange(len(vecs)), np.ones(len(vecs)), vecs, exact=False)


@pytest.fixture
def strange_codebooks(monkeypatch):
    """Codebooks as of a large table: not fitted to the few vectors of the test."""
    real, others = ed._codebook, rare_links(8000, 0, 64, 0.935, seed=4)
    monkeypatch.setattr(ed, "_codebook", lambda x, size, seed: real(others[:, :32] if seed == 1 else others[:, 32:], size, seed, 3))


def test_embedding_rare_links(spark, monkeypatch, strange_codebooks):
    """None or a handful of the queries has a link, on a grid of 129 by 129."""
    monkeypatch.setattr(ed, "QUERIES", 20)
    assert found_share(spark, rare_links(600, 60, 64, 0.935), cell_size=0.04) >= 0.97


def test_embedding_cells_grow(spark, monkeypatch, strange_codebooks):
    """Where the most cells that may be visited don't reach the recall, cells become larger."""
    monkeypatch.setattr(ed, "MOST_CELLS", 4)
    assert found_share(spark, rare_links(300, 150, 64, 0.935), cell_size=0.04) >= 0.97


def test_planted_calibration():
    """On a grid of 256 by 256, what planted partners ask for finds other links too; the least cells don't."""
    x = rare_links(12_000, 500, 64, 0.94)
    index = ed.MultiIndex(ed._codebook(x[2000:12_000, :32], 256, 1, 5), ed._codebook(x[2000:12_000, 32:], 256, 2, 5), 0.93)
    shares = ed._planted(index, x[1000:1500], 1024)
    visits = int(np.argmax(np.min(list(shares.values()), 0) >= 0.99)) + 1
    a, b = x[:500], x[12_000:]
    rank = np.minimum(ed._ranks(index, a, index.home(b), 1024), ed._ranks(index, b, index.home(a), 1024))
    assert (rank < visits).mean() >= 0.97 and (rank < ed.LEAST_CELLS).mean() < 0.9 and visits < 1024


def test_embedding_edges(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, [1.0, 0.0, 0.0, 1.0], 1), (2, [2.0, 0.0, 0.0, 2.0], 1), (3, [1.0, 0.0, 0.0, 1.0], 2), (4, [1.0, 0.0, 0.0, 1.0], None),
            (5, None, 1), (6, [0.0, 0.0, 0.0, 0.0], 1), (7, [nan, 0.0, 0.0, 1.0], 1), (8, [inf, 0.0, 0.0, 1.0], 1), (9, [1.0, None, 0.0, 1.0], 1),
            (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [], 1), (1, [1.0, 0.0, 0.0, 1.0], 1), (None, [1.0, 0.0, 0.0, 1.0], 1),
            (13, [1e30, 0.0, 0.0, 1e30], 1), (14, [1e-30, 0.0, 0.0, 1e-30], 1), (15, [-1.0, 0.0, 0.0, -1.0], 1), (16, [3.0], 1)]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").selectExpr("*", "'theirs' as k", "1 as size", "2 as u")
        got = sorted(((r.vec_id or 0), r.n_links, r.component_id or 0, r.kept) for r in ed.embedding_duplicates(df).collect())
        alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12, 15, 16)]
        alike = [(1, 4, 1, True)] * 2 + [(i, 4, 1, False) for i in (2, 13, 14)]
        assert got == sorted([*alone, *alike, (10, 1, 10, True), (11, 1, 10, False), (0, 0, 0, False)])
        assert ed.embedding_duplicates(df.limit(0)).collect() == []


def test_traversal_is_in_order():
    rng = np.random.default_rng(1)
    index = ed.MultiIndex(rng.normal(size=(6, 3)), rng.normal(size=(5, 3)), 0.93)
    x = rng.normal(size=(20, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d1, d2 = index.distances(x)
    every = (d1[:, :, None] + d2[:, None, :]).reshape(20, -1)
    for visits in (1, 4, 30):
        cells, far = index.traverse(x, visits, prune=False)
        assert np.allclose(far, np.sort(every, 1)[:, :visits]) and np.allclose(np.take_along_axis(every, cells, 1), far)
    assert (index.traverse(x, 30, prune=False)[0][:, 0] == index.home(x)).all()
    # cells that pruning leaves out hold no vector within the link distance
    y = x + 0.05 * rng.normal(size=x.shape)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = (x @ y.T) >= 0.93
    kept = [set(c) for c in index.traverse(x, 30, prune=True)[0]]
    assert all(index.home(y)[j] in kept[i] for i, j in zip(*np.nonzero(near), strict=True))


def test_schema_of_empty_documents(spark):
    assert nj.ngram_components(spark.createDataFrame([], SCHEMA)).dtypes[:3] == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
