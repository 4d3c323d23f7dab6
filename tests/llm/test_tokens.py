"""Token counts, token-ID files and packing against the tokenizers library itself."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stopflow.llm import chunks
from stopflow.llm.chunks import Encoder
from stopflow.llm.orc_ids import id_digests, read_ids, write_ids
from stopflow.llm.packing import _after, _openers, pack_documents, successor_sweep
from stopflow.llm.queries import QUERIES
from stopflow.llm.token_counts import count_tokens

from .conftest import SMALL, edge_rows

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def ids_of(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("path,spaced", [(WORD, False), (BYTE, True)])
def test_encoder_equals_library(path, spaced):
    enc = Encoder(path, spaced)
    tok = Tokenizer.from_file(path)

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list("aAbZéÉßİΣς'’s.,!<|>endoftxt 1９½ \n\n\t\r\x0b\x1c\x85  　日本́😀")), max_size=40)
           | st.text(max_size=30))
    def same(text):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    same()
    for text in ["", " ", "\n", "a  b", "a\nb c\n", " <|endoftext|>  x", "<|startoftext|>a", "x" * 9000, "don't WE'LL 'S"]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path,spaced", [(WORD, False), (BYTE, True)])
def test_texts_encoded_together(path, spaced, texts, monkeypatch):
    """Groups of texts give each text the library's ids: nulls, safe and unsafe ones side by side, slices, one text a group."""
    rnd = random.Random(7)
    alphabet = "aAbZ\u00e9\u00c9.,!<' \n\n\t\0 \u00a0\u65e5"
    some = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(300)]
    some += ["", " ", "\n", "a  b", "plain words, here.\nAnd there", "\0a b", "a \0", "<|endoftext|> x", *list(texts.values())[:50]]
    want = [np.asarray(x, "<u4").tobytes() for x in ids_of(path, some)]
    for size in (1, 500, chunks.GROUP_BYTES):
        monkeypatch.setattr(chunks, "GROUP_BYTES", size)
        enc = Encoder(path, spaced)
        assert list(enc.encode_many(pa.array(some))) == want
        assert list(enc.encode_many(pa.array([None, *some, None]).slice(5, 40))) == want[4:44]
    assert list(enc.encode_many(pa.array([None, "x"], pa.large_string()))) == [b"", enc.encode("x")]
    assert list(enc.encode_many(pa.array([], pa.string()))) == []


def test_counts(spark, texts):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op8_token_counts"](spark, SMALL).collect()}
    want = {i: (len(t.encode()), len(x), len(x) > 2048) for (i, t), x in zip(texts.items(), ids_of(WORD, texts.values()), strict=True)}
    assert got == want


def test_counts_edges(edge, clashing, none):
    rows = edge_rows()
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(x)) for r, x in zip(rows, ids_of(WORD, [r[1] for r in rows]), strict=True))
    for docs in (edge, clashing):
        # small blocks and few shards, so that several of each meet
        got = count_tokens(docs, WORD, block_bytes=4000, shards=3).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert count_tokens(none, WORD).collect() == []


def test_id_files(spark, texts):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op10_token_id_output"](spark, SMALL).collect()}
    start = 0
    for i, x in sorted(zip(texts, ids_of(WORD, texts.values()), strict=True)):
        assert got[i] == (start, len(x) + 1, crc([*x, 1]))
        start += len(x) + 1


def test_id_files_edges(spark, clashing, none, tmp_dir):
    write_ids(clashing, f"{tmp_dir}/a", WORD, end_id=1, partitions=3)
    rows = edge_rows()
    got = id_digests(spark, f"{tmp_dir}/a").orderBy("start").collect()
    assert len(got) == len(rows)
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in got[:len(rows) - len(known)])
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    want = sorted((str(r[0]), crc([*x, 1])) for r, x in zip(rows, ids_of(WORD, [r[1] for r in rows]), strict=True))
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == want
    some = read_ids(spark, f"{tmp_dir}/a", [7, 10]).collect()
    assert sorted(r.doc_id for r in some) == [7, 10]
    assert next(r.ids for r in some if r.doc_id == 7) == [*ids_of(WORD, ["one two"])[0], 1]
    write_ids(none, f"{tmp_dir}/b", WORD, end_id=1)
    assert id_digests(spark, f"{tmp_dir}/b").collect() == []


def test_id_files_prune(spark, clashing, tmp_dir):
    write_ids(clashing, f"{tmp_dir}/a", WORD, end_id=1, partitions=2)
    plan = read_ids(spark, f"{tmp_dir}/a", [7])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan


def check_packing(rows, ids, end, capacity):
    """``rows`` place every document's pieces, without holes or overlaps; returns the number of sequences."""
    per, seqs = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        at = 0
        for r in s:
            assert r.offset == at
            at += r.length
        assert at <= capacity
    for r in rows:
        per.setdefault(str(r.doc_id), []).append((r.piece, r.start, r.length, r.ids_crc32))
    want = {}
    for doc_id, x in ids:
        x, at, k = [*x, end], 0, 0
        while at < len(x):
            size = (len(x) - at) % capacity or capacity
            want.setdefault(str(doc_id), []).append((k, at, size, crc(x[at:at + size])))
            at, k = at + size, k + 1
    assert {k: sorted(v) for k, v in per.items()} == {k: sorted(v) for k, v in want.items()}
    return len(seqs)


def test_packing(spark, texts):
    rows = QUERIES["op9_best_fit_packing"](spark, SMALL).collect()
    ids = list(zip(texts, ids_of(BYTE, texts.values()), strict=True))
    least = math.ceil(sum(len(x) + 1 for _, x in ids) / 1024)
    assert check_packing(rows, ids, 2, 1024) <= 1.02 * least + 1


def test_packing_edges(clashing, none):
    src = edge_rows()
    ids = [(r[0], x) for r, x in zip(src, ids_of(BYTE, [r[1] for r in src]), strict=True)]
    for capacity in (64, 1024):
        n = check_packing(pack_documents(clashing, BYTE, 2, capacity).collect(), ids, 2, capacity)
        assert n <= 1.1 * math.ceil(sum(len(x) + 1 for _, x in ids) / capacity) + 1
    assert pack_documents(none, BYTE, 2).collect() == []


def test_sweep_and_openers():
    # the longest go first, to the smallest gap that holds them, several of a length to one gap
    assert successor_sweep({60: 1, 30: 5}, {70: 2, 100: 1}) == [(60, 0, 1, 70, 0, 1), (30, 0, 2, 70, 1, 2), (30, 2, 5, 100, 0, 3)]
    assert sorted(set(_after({70: 2, 100: 1}, [(60, 0, 1, 70, 0, 1)]))) == [10, 70, 100]
    assert _openers({60: 2, 40: 3}, 0, 100) == {60: 2, 40: 1}
    assert _openers({30: 5}, 40, 100) == {}


def test_same_length_everywhere(spark):
    """A length that all documents share."""
    docs = spark.createDataFrame([(i, "same words here") for i in range(500)], "doc_id long, text string")
    rows = pack_documents(docs, BYTE, 2, capacity=16).collect()
    size = rows[0].length
    assert len({r.sequence_id for r in rows}) == math.ceil(500 / (16 // size))
