"""Packing, Re-Pair and BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_texts import odd_strings
from tokenizers import Tokenizer

from linewatch.llm import bpe as bpe_module
from linewatch.llm import packing, queries, repair, tokens
from linewatch.llm.bpe import SpeculativeBPE, encode_decode
from linewatch.llm.tokens import Encoder, merge_ranks, tokenizer_path


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def word_level():
    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def ids_of(tokenizer, text, end) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_pieces_and_ids_equal_the_library(byte_level):
    texts = odd_strings()
    ids, edges = Encoder(tokenizer_path()).encode(pa.array(texts))
    for i, e in enumerate(byte_level.encode_batch(texts, add_special_tokens=False)):
        assert ids[edges[i] : edges[i + 1]].tolist() == e.ids, texts[i]


def test_every_token_text_is_merged_as_by_the_library(byte_level):
    ranks = merge_ranks(tokenizer_path())
    texts = [t.decode("utf-8") for t in random.Random(1).sample(sorted(ranks), 5000) if _is_text(t)]
    encoder = Encoder(tokenizer_path())
    assert encoder.merge is not None
    ids, edges = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == [e.ids for e in byte_level.encode_batch(texts, add_special_tokens=False)]


def _is_text(token: bytes) -> bool:
    try:
        return bool(token.decode("utf-8"))
    except UnicodeDecodeError:
        return False


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_in_unit_steps(dimensions, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dimensions), axis=-1).reshape(-1, dimensions)
    place = packing.hilbert(cells, bits)
    assert sorted(place) == list(range(side**dimensions))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def check_pieces(pieces, docs, tokenizer, length=2048):
    """Each document's ids lie in exactly one run of pieces, sequences have no gaps, only the last is short."""
    want = sorted((d is None, d or 0, tuple(ids_of(tokenizer, t, 1))) for d, t in docs)
    by_place = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    at = 0
    got, parts = [], []
    for r in by_place:
        assert r.sequence_id * length + r.offset == at
        assert len(r.ids) == 4 * r.length and r.offset + r.length <= length
        at += r.length
        if r.start == 0:
            parts = []
        parts += np.frombuffer(r.ids, "<u4").tolist()
        if r.start + r.length == r.doc_tokens:
            got.append((r.doc_id is None, r.doc_id or 0, tuple(parts)))
    assert sorted(got) == want


def test_packing_keeps_every_id_of_odd_rows(odd_docs, byte_level):
    check_pieces(packing.pack(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], byte_level)


def test_packing_of_the_table(spark, sf_dir, sf_docs, byte_level):
    rows = queries.op1_curve_packing(spark, sf_dir).collect()
    ids = {r.doc_id: ids_of(byte_level, r.text, 1) for r in sf_docs.collect()}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    assert all(r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(ids[r.doc_id]) for r in rows)
    short = {}
    for r in rows:
        short[r.sequence_id] = short.get(r.sequence_id, 0) + r.length
    assert sorted(short) == list(range(len(short))) and [n for s, n in sorted(short.items())][:-1] == [2048] * (len(short) - 1)


def test_neighbours_on_the_curve_are_alike(spark, sf_docs):
    rows = packing.pack(sf_docs).collect()
    lang = {r.doc_id: r.lang for r in sf_docs.collect()}
    order = [lang[r.doc_id] for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))]
    same = sum(a == b for a, b in zip(order, order[1:], strict=False)) / len(order)
    chance = sum((order.count(x) / len(order)) ** 2 for x in set(order))
    assert same > chance + 0.2


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs).collect() == []


@pytest.mark.parametrize("ids", [[], [5], [7] * 101, list(range(300)), [1, 2] * 500 + [1], [1, 1, 2] * 400])
def test_grammar_round_trip(ids):
    data = repair.pack_shard(np.array(ids, np.uint32), np.array([len(ids)], np.int64), 1000)
    shard = repair.Shard(data)
    assert shard.ids().tolist() == ids
    for a in range(0, len(ids), 37):
        assert shard.ids(a, 50).tolist() == ids[a : a + 50]


def test_grammar_shrinks_and_reads_at_random():
    rng = np.random.default_rng(3)
    phrases = [rng.integers(0, 50_000, rng.integers(3, 30)) for _ in range(100)]
    docs = [np.concatenate([phrases[i] for i in rng.integers(0, 100, rng.integers(0, 12))] or [np.zeros(0, int)]) for _ in range(600)]
    ids, lengths = np.concatenate(docs).astype(np.uint32), np.array([len(d) for d in docs])
    shard = repair.Shard(repair.pack_shard(ids, lengths, 50_257))
    assert len(shard.symbols) < len(ids) / 3
    assert all(shard.document(i).tolist() == d.tolist() for i, d in enumerate(docs))
    assert all(int(shard.sizes[i]) == len(shard._expanded(np.array([50_257 + i]))) for i in range(0, len(shard.sizes), 7))


def test_shards_hold_odd_rows_in_order(spark, odd_docs, byte_level, tmp_path):
    repair.write(odd_docs, str(tmp_path / "ids"), shard_ids=1000)
    rows = sorted(repair.read(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    want = [(r.doc_id, ids_of(byte_level, r.text, 0)) for r in odd_docs.collect()]
    assert [r.doc_id for r in rows] == sorted((d for d, _ in want), key=lambda d: (d is not None, d))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=key) == sorted(want, key=key)


def test_shards_of_the_table(spark, sf_dir, sf_docs, byte_level):
    at = 0
    got = {r.doc_id: r for r in queries.op5_repair_ids(spark, sf_dir).collect()}
    for r in sorted(sf_docs.collect(), key=lambda r: r.doc_id):
        ids = ids_of(byte_level, r.text, 0)
        assert got[r.doc_id] == (r.doc_id, at, len(ids), crc(ids))
        at += len(ids)


def test_no_shards(spark, no_docs, tmp_path):
    repair.write(no_docs, str(tmp_path / "ids"))
    assert repair.read(spark, str(tmp_path / "ids")).collect() == []


def test_speculation_equals_the_library(word_level):
    bpe = SpeculativeBPE(tokenizer_path("word_bpe_49k.json"))
    texts = odd_strings()
    for some in (texts, [t for t in texts if "<|" not in t]):
        ids, edges = bpe.encode(pa.array(some))
        decoded = bpe.decode(ids, edges).to_pylist()
        for i, e in enumerate(word_level.encode_batch(some, add_special_tokens=False)):
            assert ids[edges[i] : edges[i + 1]].tolist() == e.ids, some[i]
            assert decoded[i] == word_level.decode(e.ids, skip_special_tokens=False)
    assert 0 < bpe.failed < bpe.checked


def test_small_tables_start_anew(byte_level, word_level, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_IDS", 40)
    monkeypatch.setattr(bpe_module, "MOST_PAIRS", 5)
    texts = [t for t in odd_strings() if "<|" not in t]
    for table, library in ((Encoder(tokenizer_path()), byte_level), (SpeculativeBPE(tokenizer_path("word_bpe_49k.json")), word_level)):
        for text in texts + texts:
            assert table.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_words_merge_exactly(word_level):
    bpe = SpeculativeBPE(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(2)
    words = ["".join(rng.choice("abehinostu") for _ in range(n)) for n in (47, 48, 49, 50, 300, 2000)] + ["a" * 5000]
    assert bpe.words(words) == [e.ids for e in word_level.encode_batch(words, add_special_tokens=False)]


def test_encode_decode_of_odd_rows(odd_docs, word_level, rows):
    got = sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in encode_decode(odd_docs).collect())
    want = []
    for r in odd_docs.collect():
        ids = word_level.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), tuple(ids), word_level.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_digests_of_the_table(spark, sf_dir, sf_docs, word_level):
    text = {r.doc_id: r.text for r in sf_docs.collect()}
    for r in queries.op10_speculative_bpe(spark, sf_dir).collect():
        ids = word_level.encode(text[r.doc_id], add_special_tokens=False).ids
        decoded = word_level.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_encode_nothing(no_docs):
    assert encode_decode(no_docs).collect() == []
