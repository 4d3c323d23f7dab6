"""The quality classifier against a plain model, and the pipeline against brute force."""

import math
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from stopflow.llm import quality as q
from stopflow.llm.queries import QUERIES

from .conftest import SMALL, edge_rows
from .test_similarity import brute_join
from .test_text_operators import brute_dedup
from .test_tokens import check_packing, ids_of


def units(text):
    raw = (text or "").encode("utf-16-le", "surrogatepass")
    return [int.from_bytes(raw[i:i + 2], "little") for i in range(0, len(raw), 2)]


class Plain:
    """Interpolated modified Kneser-Ney over tuples of units."""

    def __init__(self, texts):
        top = Counter()
        for t in texts:
            u = [q.START] * 3 + units(t)
            top.update(tuple(u[i:i + 4]) for i in range(len(u) - 3))
        self.levels = {4: top}
        for k in (3, 2, 1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.tables = {k: self.table(c) for k, c in self.levels.items()}

    def table(self, counts):
        n = [sum(v == i for v in counts.values()) for i in range(5)]
        d = [0, 0.5, 1.0, 1.5]
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            d = [0] + [max(i / 10, min(i, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)]
        total, off = defaultdict(int), defaultdict(float)
        for g, v in counts.items():
            total[g[:-1]] += v
            off[g[:-1]] += d[min(v, 3)]
        return {g: max(v - d[min(v, 3)], 0) / total[g[:-1]] for g, v in counts.items()}, {c: off[c] / total[c] for c in total}

    def p(self, g):
        own, rest = self.tables[len(g)]
        below = self.p(g[1:]) if len(g) > 1 else 1 / (len(own) + 1)
        return own.get(g, 0.0) + rest.get(g[:-1], 1.0) * below

    def nll(self, text):
        u = [q.START] * 3 + units(text)
        return -sum(math.log(self.p(tuple(u[i:i + 4]))) for i in range(len(u) - 3))


def test_perplexity_equals_plain_model(spark, edge):
    trusted = {1, 3, 10, 99}
    ids = spark.createDataFrame([(i,) for i in [*trusted, 1, None]], "doc_id long")
    got = q.perplexities(edge, ids).collect()
    rows = edge_rows()
    assert len(got) == len(rows)
    by_lang = defaultdict(list)
    for r in rows:
        if r[0] in trusted:
            by_lang[r[2] or ""].append(r[1])
    want = []
    for r in rows:
        u = len(units(r[1]))
        model = Plain(by_lang[r[2] or ""]) if by_lang[r[2] or ""] else None
        # without a model every unit has the same probability
        want.append((str(r[0]), r[2] or "", u, round(model.nll(r[1]) if model else u * 16 * math.log(2), 5)))
    assert sorted((str(r.doc_id), r.lang, r.units, round(r.nll, 5)) for r in got) == sorted(want)


def test_probabilities_sum_to_one():
    model = Plain(["abracadabra", "alakazam", "abc"])
    seen = {g[0] for g in model.levels[1]}
    for context in ((q.START,) * 3, tuple(units("bra")), tuple(units("zzz"))):
        assert abs(sum(model.p((*context, u)) for u in seen) + model.p((*context, 9)) - 1) < 1e-9


def test_classifier(spark):
    got = QUERIES["op6_quality_classifier"](spark, SMALL).toPandas()
    labels = duckdb.connect().execute(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    assert len(got) == 200 and both[both.quality == 1].keep.mean() >= 0.95
    assert both[both.quality == 0].keep.mean() <= 0.5
    assert (got.keep == ((got.score <= got.threshold) | got.threshold.isna())).all()


def test_classifier_edges(spark, clashing, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, None), (3, 0, 0), (9, 1, 1), (None, 1, 0), (11, 1, 0), (12, None, None)],
                                   "doc_id long, quality int, toxic int")
    assert sorted(r.doc_id for r in q.trusted_ids(labels).dropna().collect()) == [1, 1, 2, 11]
    rows = q.classify(clashing, labels).collect()
    assert len(rows) == len(edge_rows())
    assert all(r.keep for r in rows if r.threshold is None) and all(r.perplexity == 1 for r in rows if r.units == 0)
    kept = q.keep_good(clashing, labels)
    assert kept.columns == clashing.columns
    bad = sorted((str(r.doc_id), r.x) for r in rows if not r.keep)
    assert kept.count() == len(rows) - len(bad)
    assert q.classify(none, labels).collect() == [] and q.keep_good(none, labels).collect() == []
    assert all(r.keep for r in q.classify(clashing, labels.limit(0)).collect())


def test_registered():
    names = __spark_entry__.queries()
    assert [n.split("_")[0] for n in sorted(names, key=lambda n: (len(n.split("_")[0]), n)) if n.startswith("op") and n[2].isdigit()] \
        == [f"op{i}" for i in range(1, 14)]
    assert names["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and returns, written and read again."""
    top = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{top}/{name}")
        new = spark.read.parquet(f"{top}/{name}")
        out[name] = docs, new
        docs = new
    return out


def test_stages_keep_columns(stages):
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "mix", "pack"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(new.columns == columns for name, (_, new) in stages.items() if name != "pack")


def test_quality_stage(spark, stages):
    docs, new = stages["quality"]
    keep = {r.doc_id for r in q.classify(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect() if r.keep}
    assert {r.doc_id for r in new.collect()} == keep


def test_line_stage(stages):
    docs, new = stages["line_dedup"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i: t for (i, _), t in zip(rows, brute_dedup(rows), strict=True)}
    got = {r.doc_id: r for r in new.collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_near_stage(stages):
    docs, new = stages["near_dedup"]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    _, comp = brute_join(rows, 5, (4, 5))
    assert sorted(r.doc_id for r in new.collect()) == [i for k, (i, _) in enumerate(rows) if comp[k] == k]


def test_mix_stage(spark, stages):
    docs, new = stages["mix"]
    from stopflow.llm.mixing import mix_sources

    want = Counter(r.doc_id for r in mix_sources(docs).collect())
    assert Counter(r.doc_id for r in new.collect()) == want
    source = {r.doc_id: r.source for r in docs.collect()}
    assert all(r.source == source[r.doc_id] for r in new.collect())


def test_pack_stage(stages):
    docs, new = stages["pack"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ids = list(zip((i for i, _ in rows), ids_of(public_tokenizers.path("byte_bpe_50k.json"), [t for _, t in rows]), strict=True))
    least = math.ceil(sum(len(x) + 1 for _, x in ids) / 1024)
    assert check_packing(new.collect(), ids, 2, 1024) <= 1.02 * least + 1


def test_pipeline_of_nothing(spark, none, tmp_dir):
    """Empty tables go through all stages."""
    none.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    got = corpus_pipeline.run(spark, tmp_dir)
    assert got.collect() == [] and "sequence_id" in got.columns


def test_pipeline_of_edges(spark, clashing, tmp_dir):
    """Nulls, repeated rows and ids, empty texts and clashing names (one with a dot) go through all stages; columns stay until the last."""
    from pyspark.sql import functions as F

    docs = clashing.withColumn("a.b", F.lit("dotted"))
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (9, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, tmp_dir).write.parquet(f"{tmp_dir}/{name}")
        new = spark.read.parquet(f"{tmp_dir}/{name}")
        assert new.columns == docs.columns and new.count() > 0
        docs = new
    left = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tmp_dir).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed) >= left
