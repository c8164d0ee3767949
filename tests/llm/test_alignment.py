"""Groups of two tokenizers' ids against the libraries, and fragments joined in any order."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_texts import odd_strings
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from linewatch.llm import alignment, queries
from linewatch.llm.alignment import Fragment, Tokens
from linewatch.llm.tokens import byte_letters, tokenizer_path
from linewatch.llm.words import Characters
from linewatch.session import staged

PIECES = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    """id and bytes of each token of both libraries."""
    first = Tokenizer.from_file(tokenizer_path())
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    back = {c: b for b, c in enumerate(byte_letters())}

    def tokens(text):
        e = first.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(back[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
        b = [(i, bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()) for i in second.encode(text)]
        return a, b

    return tokens


def plain_groups(a, b, raw):
    """Lists of ids between common ends, none if a side's bytes are not the text's."""
    if any(b"".join(t for _, t in side) != raw for side in (a, b)):
        return []
    out, i, j, x, y = [], 0, 0, 0, 0
    while i < len(a):
        own, other = [], []
        while True:
            if not own or x < y:
                own.append(a[i][0])
                x += len(a[i][1])
                i += 1
            elif not other or y < x:
                other.append(b[j][0])
                y += len(b[j][1])
                j += 1
            if own and other and x == y:
                break
        out.append((own, other))
    return out


def expected(texts, tokens):
    """n_a, n_b, n_groups, n_links, groups, n_best, count_sum of each text."""
    found, docs = [], Counter()
    for text in texts:
        groups = plain_groups(*tokens(text), (" " + text).encode()) if text else []
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        docs.update(links.keys())
        found.append((groups, links))
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    return [
        (
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            sum(links.values()),
            ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups),
            sum(n for (x, y), n in links.items() if docs[x, y] == best[x]),
            sum(n * docs[p] for p, n in links.items()),
        )
        for groups, links in found
    ]


def rows_of(frame):
    return sorted(((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum)) for r in frame.collect()), key=str)


def test_tokens_equal_the_libraries(library):
    texts = [*odd_strings(), "a▁b", "<s>a</s> <unk><0x41>", "\x00a", "<|endoftext|>"]
    column = alignment._with_blank(pa.array(texts))
    sides = [e.encode(column) for e in (alignment.first_encoder(tokenizer_path()), alignment.second_encoder(tokenizer_path(PIECES)))]
    for i, text in enumerate(texts):
        for (ids, edges), want in zip(sides, library(text), strict=True):
            assert ids[edges[i] : edges[i + 1]].tolist() == ([x for x, _ in want] if text else []), text


def test_odd_rows_short_and_cut(spark, odd_docs, no_docs, library):
    docs = odd_docs.collect()
    want = sorted(((d.doc_id, w) for d, w in zip(docs, expected([d.text or "" for d in docs], library), strict=True)), key=str)
    for part_bytes in (1 << 16, 50, 20_000):
        assert rows_of(alignment.with_link_counts(staged(alignment.align(odd_docs, part_bytes=part_bytes)))) == want, part_bytes
    assert alignment.with_link_counts(staged(alignment.align(no_docs))).collect() == []


@pytest.mark.parametrize("part_bytes", [7, 40, 1 << 16])
def test_any_cut_gives_the_same(spark, library, part_bytes):
    rng = random.Random(4)
    strings = odd_strings()
    texts = [" ".join(rng.sample(strings, 12)) for _ in range(25)] + ["aaaaaaaaaaaaaaaaaaaaaaaaa" * 9, "日本語" * 50, "don't we'll 's'll've x" * 8, "a▁b" * 30, "x" * 39 + "é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(alignment.with_link_counts(staged(alignment.align(docs, part_bytes=part_bytes)))) == sorted(enumerate(expected(texts, library)), key=str)


def test_both_may_be_cut_at_their_cuts(library):
    for text in [" " + t for t in odd_strings()[:600] if t]:
        chars = Characters.of([text])
        for encoder in (alignment.first_encoder(tokenizer_path()), alignment.second_encoder(tokenizer_path(PIECES))):
            whole = encoder.encode(pa.array([text]))[0].tolist()
            places = [0, *np.flatnonzero(encoder.cuts(chars)).tolist(), len(text)]
            parts = [encoder.encode(pa.array([text[a:b]]))[0].tolist() for a, b in zip(places, places[1:], strict=False)]
            assert [i for p in parts for i in p] == whole, text


def state(f):
    arrays = [x.tolist() for side in (*f.head, *f.tail) for x in (side.ids, side.ends)]
    return f.cut, f.text, f.n_groups, f.pairs.tolist(), f.times.tolist(), f.n_a, f.n_b, arrays


def test_joining_is_associative_and_canonical():
    rng = random.Random(5)
    for _ in range(300):
        size = rng.randint(1, 60)
        sides = []
        for _ in range(2):
            ends = sorted(rng.sample(range(1, size + 1), rng.randint(0, min(size, 20))))
            sides.append(Tokens(np.array([rng.randint(0, 4) for _ in ends], np.int64), np.array(ends, np.int64)))
        cuts = [[0, *sorted(rng.randint(0, len(s.ids)) for _ in range(5)), len(s.ids)] for s in sides]
        parts = [Fragment.of(*(Tokens(s.ids[c[i] : c[i + 1]], s.ends[c[i] : c[i + 1]]) for s, c in zip(sides, cuts, strict=True))) for i in range(6)]
        want = state(Fragment.of(*sides))
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [Fragment.unpack((parts[i] + parts[i + 1]).pack())]
        assert state(parts[0]) == want


def test_groups_of_many_links():
    n, m = 70, 90
    a, b = Tokens(np.arange(n) % 7, np.arange(1, n + 1) * 2 - 1), Tokens(np.arange(m) % 5, np.arange(1, m + 1) * 2)
    a, b = a + Tokens(np.array([7]), np.array([1000])), b + Tokens(np.array([9]), np.array([1000]))
    found = Fragment.of(a, b).whole()
    want = Counter((x << alignment.ID_BITS) | y for x in a.ids.tolist() for y in b.ids.tolist())
    assert dict(zip(found.pairs.tolist(), found.times.tolist(), strict=True)) == want and found.n_groups == 1


def test_the_query(spark, sf_dir, sf_docs, library):
    docs = sf_docs.collect()
    want = {d.doc_id: w for d, w in zip(docs, expected([d.text or "" for d in docs], library), strict=True)}
    rows = queries.op13_fragment_monoid(spark, sf_dir).collect()
    assert len(rows) == len(want)
    for r in rows:
        n_a, n_b, n_groups, n_links, groups, n_best, count_sum = want[r.doc_id]
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, digest, n_best, count_sum)


def test_other_piece_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer_path(PIECES), "rb") as f:
        spec.ParseFromString(f.read())
    spec.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="leaves texts as they are"):
        alignment.PieceEncoder(str(path))
