"""Two tokenizers' ids of the same texts, cut into groups that cover the same bytes, and the pairs so linked.

Byte offsets where tokens of both end cut a text into groups. A stretch of a text is a
fragment: the open head up to the first common end, the closed groups after it, and
the open tail after the last. Joining two fragments aligns the tail of the one with the head of the
other and leaves the rest alone; this is associative, so the parts of a very long text are cut,
each for each tokenizer where none of its tokens can cross, aligned in tasks of their own and joined as a tree.

Counts of linked pairs over the corpus reach a chunk of texts through joins on its distinct
pairs, so they grow with the input and are never broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from ..session import staged
from .common import bounds, ragged, text_chunks, utf8
from .tokens import Encoder, PieceTable, byte_letters, tokenizer_path
from .words import SPACE, Characters, char_kinds

TEXT_BYTES = 150_000  # of texts aligned at once
PART_BYTES = 1 << 16  # of a long text in one fragment
FAN = 16  # fragments joined in one task of a round
CHUNK_PAIRS = 200_000  # distinct pairs of texts, summed, that share a table of pairs
MANY = 256  # links of a group that are listed one by one
ID_BITS = 20
BLANK = 0x2581

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, chunk long, links binary, pairs array<long>, in_docs array<int>"
PARTS = "key long, doc_id long, part int, parts int, a_start long, a_text string, b_start long, b_text string"
FRAGMENTS = "key long, doc_id long, part int, state binary"


class PlainEncoder(Encoder):
    """Byte-level BPE that takes the strings of special tokens for text; ``bytes_of`` are its tokens' bytes."""

    def __init__(self, path: str):
        super().__init__(path)
        self.added = []
        self.tokenizer.encode_special_tokens = True
        back = {c: b for b, c in enumerate(byte_letters())}
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.bytes_of = TokenBytes([bytes(back[c] for c in t) if set(t) <= set(back) else t.encode() for t in tokens])
        self.beside = np.zeros((256, 256), bool)  # bytes that stand side by side in a token
        for t in tokens:
            raw = [back.get(c, 0) for c in t]
            self.beside[raw[:-1], raw[1:]] = True
        if self.merge:
            self.tokenizer = None  # merges go by its ranks alone

    def cuts(self, chars: Characters) -> np.ndarray:
        """Before which characters a text may be cut: no piece or merge can reach over."""
        kinds, codes = char_kinds()[chars.codes], chars.codes
        n = len(codes)
        space, quote = kinds == SPACE, codes == 39
        fine = np.zeros(n, bool)
        if n < 3:
            return fine
        fine[1:-1] = (codes[1:-1] == 32) & ~space[:-2] & ~space[2:]
        raw = chars.text.encode("utf-8", "surrogatepass")
        data = np.frombuffer(raw, np.uint8)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        apart = ~self.beside[data[heads[1:] - 1], data[heads[1:]]]
        apart &= ~space[1:] & ~space[:-1]
        fine[1:] |= apart
        for back in range(4):  # contractions reach three characters on
            fine[back:] &= ~quote[: n - back]
        return fine


class PieceEncoder(PieceTable):
    """A piece model's ids of texts, as its library gives them for the text after the blank it begins with.

    Texts are cut between characters that stand side by side in no piece, since no merge can
    reach over; each different stretch is encoded once per worker.
    """

    def __init__(self, path: str):
        super().__init__()
        self.model = SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        rule = spec.normalizer_spec
        if rule.name != "identity" or rule.remove_extra_whitespaces or not rule.add_dummy_prefix or spec.trainer_spec.model_type != spec.trainer_spec.BPE:
            raise ValueError("the piece model must be BPE that leaves texts as they are and adds a blank")
        count = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(count)]
        plain = [not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)) for i in range(count)]
        self.bytes_of = TokenBytes([bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(chr(BLANK), " ").encode() if plain[i] else b"" for i, p in enumerate(pieces)])
        letters = sorted({c for p, ok in zip(pieces, plain, strict=True) if ok for c in p})
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.number[32] = self.number[BLANK]
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for p, ok in zip(pieces, plain, strict=True):
            if ok:
                at = self.number[[ord(c) for c in p]]
                self.beside[at[:-1], at[1:]] = True
        self.lead = next(chr(c) for c in range(10, 0xD800) if not self.number[c])  # no piece has it
        self.leading = len(self.model.encode(self.lead))

    def cuts(self, chars: Characters) -> np.ndarray:
        fine = np.zeros(len(chars.codes), bool)
        at = self.number[chars.codes]
        fine[1:] = ~self.beside[at[:-1], at[1:]]
        return fine

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        return [e[self.leading :] for e in self.model.encode([self.lead + p for p in pieces], num_threads=1)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that begin with their blank, in a row, and the edges of each text's ids."""
        data, offsets = utf8(column)
        chars = Characters(data, offsets)
        n = len(chars.codes)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        first = self.cuts(chars)
        first[chars.offsets[chars.offsets < n]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        which, keys = pd.factorize(chars.hashes(starts, ends))
        at = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
        place = self.places(keys, lambda new: self._encoded([chars.text[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]))[which]
        ids, sizes = self.gather(place)
        return ids, bounds(sizes)[np.searchsorted(starts, chars.offsets)]


class TokenBytes:
    """The bytes of every id."""

    def __init__(self, tokens: list[bytes]):
        if len(tokens) > 1 << ID_BITS:
            raise ValueError(f"more than {1 << ID_BITS} ids")
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.edges = bounds(self.sizes)
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.edges[ids], self.sizes[ids])]


@cache
def first_encoder(path: str) -> PlainEncoder:
    return PlainEncoder(path)


@cache
def second_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


@cache
def _decimals(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eight bytes with the decimal digits of each number below ``count``, commas after them, and how many digits it has."""
    numbers = np.arange(count)
    width = 1 + sum((numbers >= 10**i).astype(np.uint8) for i in range(1, 7))
    digits = np.full((count, 8), ord(","), np.uint8)
    for i in range(7):
        has = width > i
        digits[has, i] = ord("0") + numbers[has] // 10 ** (width[has].astype(np.int64) - 1 - i) % 10
    return digits.view(np.uint64)[:, 0], width


@dataclass
class Tokens:
    """Ids of a stretch by one tokenizer, and the byte offsets of their ends."""

    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ends: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate((self.ids, other.ids)), np.concatenate((self.ends, other.ends)))

    def cut(self, a: int, b: int) -> Tokens:
        """The tokens that end after ``a`` and at ``b`` at the latest."""
        i, j = np.searchsorted(self.ends, (a, b), side="right")
        return Tokens(self.ids[i:j], self.ends[i:j])


def common_ends(a: Tokens, b: Tokens) -> np.ndarray:
    if not len(b.ends):
        return b.ends
    at = np.minimum(np.searchsorted(b.ends, a.ends), len(b.ends) - 1)
    return a.ends[b.ends[at] == a.ends]


class Groups:
    """Closed groups of tokens: every token ends at one of the ``common`` ends or before it."""

    def __init__(self, a: Tokens, b: Tokens, common: np.ndarray):
        self.n = len(common)
        self.a, self.b = a.ids.astype(np.int64), b.ids.astype(np.int64)
        self.a_group, self.b_group = np.searchsorted(common, a.ends), np.searchsorted(common, b.ends)
        self.a_count, self.b_count = (np.bincount(g, minlength=self.n) for g in (self.a_group, self.b_group))

    def texts(self) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;`` of every group in a row, and the n + 1 edges of the groups' bytes."""
        a_edges, b_edges = bounds(self.a_count), bounds(self.b_count)
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[np.arange(len(self.a)) + b_edges[self.a_group]] = self.a
        ids[np.arange(len(self.b)) + a_edges[self.b_group + 1]] = self.b
        digits, width = _decimals(1 << max(16, int(ids.max(initial=0)).bit_length()))
        rows, width = digits[ids].view(np.uint8).reshape(-1, 8), width[ids]
        for last, mark in ((a_edges[1:] + b_edges[:-1] - 1, b"|"), (a_edges[1:] + b_edges[1:] - 1, b";")):
            rows[last, width[last]] = mark[0]
        edges = bounds(width + np.int64(1))
        return rows[np.arange(8) <= width[:, None]], edges[a_edges + b_edges]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of linked ids as one number, with the group and how often; a pair may come more than once."""
        product = self.a_count * self.b_count
        few = np.flatnonzero(product[self.a_group] <= MANY)
        repeats, b_edges = self.b_count[self.a_group[few]], bounds(self.b_count)
        i, j = np.repeat(few, repeats), ragged(b_edges[self.a_group[few]], repeats)
        found = [((self.a[i] << ID_BITS) | self.b[j], self.a_group[i], np.ones(len(i), np.int64))]
        a_edges = bounds(self.a_count)
        for g in np.flatnonzero(product > MANY).tolist():
            a, n = np.unique(self.a[a_edges[g] : a_edges[g + 1]], return_counts=True)
            b, m = np.unique(self.b[b_edges[g] : b_edges[g + 1]], return_counts=True)
            found.append((((a << ID_BITS)[:, None] | b).ravel(), np.full(len(a) * len(b), g), (n[:, None] * m).ravel()))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


@dataclass
class Fragment:
    """A stretch of a text; without ``cut`` all its tokens are in the head."""

    head: tuple[Tokens, Tokens]
    cut: bool = False
    tail: tuple[Tokens, Tokens] = field(default_factory=lambda: (Tokens(), Tokens()))
    text: bytes = b""  # the closed groups, each with a semicolon
    n_groups: int = 0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_a: int = 0
    n_b: int = 0
    same: bool = True  # the tokens' bytes are the text's

    @staticmethod
    def of(a: Tokens, b: Tokens) -> Fragment:
        common = common_ends(a, b)
        n_a, n_b = len(a.ids), len(b.ids)
        if not len(common):
            return Fragment((a, b), n_a=n_a, n_b=n_b)
        first, last, end = int(common[0]), int(common[-1]), 1 << 62
        found = Fragment((a.cut(-1, first), b.cut(-1, first)), True, (a.cut(last, end), b.cut(last, end)), n_a=n_a, n_b=n_b)
        return found._closed(a.cut(first, last), b.cut(first, last), common[1:])

    def _closed(self, a: Tokens, b: Tokens, common: np.ndarray) -> Fragment:
        """Adds groups after those that are closed."""
        if len(common):
            groups = Groups(a, b, common)
            pairs, _, times = groups.links()
            self._add(groups.texts()[0].tobytes(), groups.n, pairs, times)
        return self

    def _add(self, text: bytes, n_groups: int, pairs: np.ndarray, times: np.ndarray) -> None:
        self.text, self.n_groups = self.text + text, self.n_groups + n_groups
        self.pairs, self.times = _summed(np.concatenate((self.pairs, pairs)), np.concatenate((self.times, times)))

    def __add__(self, other: Fragment) -> Fragment:
        left = self.tail if self.cut else self.head
        middle = Fragment.of(left[0] + other.head[0], left[1] + other.head[1])
        out = Fragment(self.head, True, middle.tail, self.text, self.n_groups, self.pairs, self.times) if self.cut else middle
        if self.cut:
            if middle.cut:
                out._closed(*middle.head, np.array([middle.head[0].ends[-1]]))
                out._add(middle.text, middle.n_groups, middle.pairs, middle.times)
            else:
                out.tail = middle.head
        if other.cut:
            out._add(other.text, other.n_groups, other.pairs, other.times)
            out.tail = other.tail
        out.n_a, out.n_b, out.same = self.n_a + other.n_a, self.n_b + other.n_b, self.same and other.same
        return out

    def whole(self) -> Fragment:
        """The fragment of a whole text: its begin closes the head, and its end is common."""
        if not self.same or not self.cut:
            return Fragment((Tokens(), Tokens()))
        out = Fragment((Tokens(), Tokens()), True, n_a=self.n_a, n_b=self.n_b)
        out._closed(*self.head, np.array([self.head[0].ends[-1]]))
        out._add(self.text, self.n_groups, self.pairs, self.times)
        return out

    def pack(self) -> bytes:
        arrays = [x for side in (*self.head, *self.tail) for x in (side.ids, side.ends)] + [self.pairs, self.times]
        numbers = np.array([self.cut, self.n_groups, self.n_a, self.n_b, self.same, *map(len, arrays)], np.int64)
        return zstandard.ZstdCompressor(1).compress(b"".join((numbers.tobytes(), *(x.astype(np.int64).tobytes() for x in arrays), self.text)))

    @staticmethod
    def unpack(state: bytes) -> Fragment:
        data = zstandard.ZstdDecompressor().decompress(state)
        cut, n_groups, n_a, n_b, same, *sizes = np.frombuffer(data, np.int64, 15).tolist()
        edges = bounds(np.array(sizes)) + 15
        x = [np.frombuffer(data, np.int64, n, 8 * at) for n, at in zip(sizes, edges.tolist(), strict=False)]
        text = data[8 * int(edges[-1]) :]
        return Fragment((Tokens(x[0], x[1]), Tokens(x[2], x[3])), bool(cut), (Tokens(x[4], x[5]), Tokens(x[6], x[7])), text, n_groups, x[8], x[9], n_a, n_b, bool(same))


class Chunk:
    """Texts that share a table of their distinct pairs; ``links`` are places in it and times."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.rows: list[tuple] = []  # doc_id, n_a, n_b, n_groups, n_links, groups
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, row: tuple, pairs: np.ndarray, times: np.ndarray) -> None:
        self.rows.append(row)
        self.pairs.append(pairs)
        self.times.append(times)
        self.size += len(pairs)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The rows of :data:`ALIGNED`, the table of pairs in one of its own."""
        sizes = np.array([len(p) for p in self.pairs], np.int64)
        distinct, place, in_docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        edges, pack = bounds(sizes), zstandard.ZstdCompressor(1).compress
        links = [pack(np.concatenate((np.diff(place[a:b], prepend=0), t)).astype(np.int32).tobytes()) for a, b, t in zip(edges, edges[1:], self.times, strict=False)]
        kinds = [*[pa.int64()] * 5, pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = [c.split()[0] for c in ALIGNED.split(", ")]
        table = (None,) * 6 + (self.number, None, distinct, in_docs.astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(table, kinds, strict=True)], names)
        for a in range(0, len(self.rows), 200):
            rows = [(*r, self.number, x, None, None) for r, x in zip(self.rows[a : a + 200], links[a : a + 200], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _unpacked(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(links), np.int32)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :].astype(np.int64)


def _with_blank(column: pa.Array) -> pa.Array:
    """A blank before each text that is not empty."""
    column = pc.fill_null(column, "")
    return pc.if_else(pc.equal(column, ""), "", pc.binary_join_element_wise(" ", column, ""))


def _tokens(column: pa.Array, first: str, second: str) -> tuple[Tokens, np.ndarray, Tokens, np.ndarray, np.ndarray]:
    """Both tokenizers' tokens of texts that begin with a blank, with the edges of each text's, and whether each text's bytes are kept.

    Ends count through all texts.
    """
    data, offsets = utf8(column)
    sides, same = [], np.ones(len(column), bool)
    for encoder in (first_encoder(first), second_encoder(second)):
        ids, edges = encoder.encode(column)
        ids = ids.astype(np.int64)
        ends = np.cumsum(encoder.bytes_of.sizes[ids])
        own = bounds(encoder.bytes_of.sizes[ids])[edges]
        if np.array_equal(own, offsets):
            wrong = encoder.bytes_of.joined(ids) != data
            same[np.searchsorted(offsets, np.flatnonzero(wrong), side="right") - 1] = False
        else:
            for t in range(len(column)):
                same[t] &= encoder.bytes_of.joined(ids[edges[t] : edges[t + 1]]).tobytes() == data[offsets[t] : offsets[t + 1]].tobytes()
            lengths = np.diff(edges)
            ends = ends + np.repeat(offsets[:-1] - own[:-1], lengths)
        sides += [Tokens(ids, ends), edges]
    return *sides, same


def _align_whole(column: pa.Array, ids: list, chunk: Chunk, first: str, second: str) -> None:
    """Adds the rows of whole texts to a chunk."""
    a, a_edges, b, b_edges, same = _tokens(_with_blank(column), first, second)
    if not same.all():  # texts whose bytes are not kept have no tokens
        a, b = (Tokens(t.ids[k], t.ends[k]) for t, k in ((t, np.repeat(same, np.diff(e))) for t, e in ((a, a_edges), (b, b_edges))))
        a_edges, b_edges = (bounds(np.where(same, np.diff(e), 0)) for e in (a_edges, b_edges))
    common = common_ends(a, b)
    groups = Groups(a, b, common)
    text, text_edges = groups.texts()
    pairs, group, times = groups.links()
    g_edges = np.searchsorted(groups.a_group, np.arange(groups.n + 1))  # the first token of each group
    g_edges = np.searchsorted(g_edges, a_edges)  # the groups of each text
    owner = np.repeat(np.arange(len(ids)), np.diff(g_edges))
    keys, times = _summed((owner[group] << 2 * ID_BITS) | pairs, times)
    edges = np.searchsorted(keys, np.arange(len(ids) + 1) << 2 * ID_BITS)
    n_links = np.add.reduceat(np.append(times, 0), edges[:-1]) if len(ids) else edges
    raw = text.tobytes()
    for t, doc_id in enumerate(ids):
        x, y = edges[t], edges[t + 1]
        own = raw[text_edges[g_edges[t]] : max(text_edges[g_edges[t]], text_edges[g_edges[t + 1]] - 1)].decode()
        row = (doc_id, int(a_edges[t + 1] - a_edges[t]), int(b_edges[t + 1] - b_edges[t]), int(g_edges[t + 1] - g_edges[t]), int(n_links[t]) if x < y else 0, own)
        chunk.add(row, keys[x:y] & ((1 << 2 * ID_BITS) - 1), times[x:y])


def _cut_long(docs: DataFrame, first: str, second: str, part_bytes: int) -> DataFrame:
    """:data:`PARTS` of long texts: stretches of about ``part_bytes``, for each tokenizer cut where it may be."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for batch in text_chunks(batches, "text", 1):
            text = " " + batch.column("text")[0].as_py()
            chars = Characters.of([text])
            widths = 1 + (chars.codes > 0x7F).astype(np.int64) + (chars.codes > 0x7FF) + (chars.codes > 0xFFFF)
            offsets = bounds(widths)
            targets = np.searchsorted(offsets, np.arange(1, math.ceil(offsets[-1] / part_bytes)) * part_bytes)
            sides = []
            for encoder in (first_encoder(first), second_encoder(second)):
                places = np.append(np.flatnonzero(encoder.cuts(chars)), len(text))
                sides.append([0, *places[np.searchsorted(places, targets)].tolist(), len(text)])
            rows = [
                (key, batch.column("doc_id")[0].as_py(), i, len(targets) + 1, int(offsets[a]), text[a:b], int(offsets[c]), text[c:d])
                for i, (a, b, c, d) in enumerate(zip(sides[0], sides[0][1:], sides[1], sides[1][1:], strict=False))
            ]
            key += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            names = [c.split()[0] for c in PARTS.split(", ")]
            for a in range(0, len(rows), 16):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[a : a + 16], strict=True), kinds, strict=True)], names)

    return docs.mapInArrow(work, PARTS)


def _fragments(parts: DataFrame, first: str, second: str) -> DataFrame:
    def side(encoder: PlainEncoder | PieceEncoder, start: int, text: str) -> tuple[Tokens, bool]:
        ids = encoder.encode(pa.array([text]))[0].astype(np.int64)
        return Tokens(ids, start + np.cumsum(encoder.bytes_of.sizes[ids])), encoder.bytes_of.joined(ids).tobytes() == text.encode("utf-8", "surrogatepass")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, a_same = side(first_encoder(first), row["a_start"], row["a_text"])
                b, b_same = side(second_encoder(second), row["b_start"], row["b_text"])
                found = Fragment.of(a, b)
                found.same = a_same and b_same
                yield _fragment_batch(row["key"], row["doc_id"], row["part"], found)

    return parts.mapInArrow(work, FRAGMENTS)


def _fragment_batch(key: int, doc_id: int | None, part: int, found: Fragment) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((key, doc_id, part, found.pack()), kinds, strict=True)], [c.split()[0] for c in FRAGMENTS.split(", ")])


def _joined(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    total = Fragment.unpack(rows[0]["state"])
    for r in rows[1:]:
        total = total + Fragment.unpack(r["state"])
    return pa.Table.from_batches([_fragment_batch(rows[0]["key"], rows[0]["doc_id"], rows[0]["part"] // FAN, total)])


def _long_texts(docs: DataFrame, first: str, second: str, part_bytes: int) -> DataFrame:
    """:data:`ALIGNED` of long texts: fragments of parts, joined ``FAN`` at a time until each text is one; each is a chunk of its own."""
    parts = staged(_cut_long(docs, first, second, part_bytes))
    most = parts.agg(F.max("parts")).first()[0] or 0
    found = _fragments(parts.repartition("key", "part"), first, second)
    while most > 1:
        found = found.groupBy("key", F.floor(F.col("part") / FAN)).applyInArrow(_joined, FRAGMENTS)
        most = math.ceil(most / FAN)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                whole = Fragment.unpack(row["state"]).whole()
                chunk = Chunk(-1 - row["key"])
                n_links = int(whole.times.sum())
                chunk.add((row["doc_id"], whole.n_a, whole.n_b, whole.n_groups, n_links, whole.text[:-1].decode()), whole.pairs, whole.times)
                yield from chunk.batches()

    return found.mapInArrow(close, ALIGNED)


def align(docs: DataFrame, first: str | None = None, second: str | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """:data:`ALIGNED` of every row of ``docs`` (doc_id, text) for :func:`with_link_counts`; rows with ``pairs`` are tables of a chunk.

    ``first`` is the file of a byte-level BPE, ``second`` that of a piece model; both read the
    text after a blank, and strings of special tokens in it are text. ``groups`` holds each group's ids
    as ``a1,a2|b1``, groups apart by semicolons. Texts that are null or empty, or whose bytes a tokenizer does not
    keep, have no tokens. Texts beyond ``part_bytes`` bytes are cut and joined as fragments over tasks, with the same
    result; a stretch where a tokenizer can't be cut stays in one part. Repeated rows and a null
    doc_id are rows like others, an empty table gives no row, and other columns may have any name.
    """
    first, second = first or tokenizer_path(), second or tokenizer_path("piece_bpe_32k.model")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > part_bytes, F.lit(False))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        chunk = Chunk(number)
        for batch in text_chunks(batches, "text", TEXT_BYTES):
            _align_whole(batch.column("text"), batch.column("doc_id").to_pylist(), chunk, first, second)
            if chunk.size >= CHUNK_PAIRS:
                yield from chunk.batches()
                chunk = Chunk(chunk.number + 1)
        if chunk.rows:
            yield from chunk.batches()

    return docs.where(~is_long).mapInArrow(work, ALIGNED).unionByName(_long_texts(docs.where(is_long), first, second, part_bytes))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, docs and best of every linked pair: in how many texts, and whether no pair of the same first id is in more.

    ``pair`` is the first id times 2**20, plus the second. The window's groups are bounded by the second vocabulary.
    """
    pairs = aligned.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "in_docs")).alias("x"))
    counts = pairs.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.in_docs").alias("docs"))
    most = F.max("docs").over(Window.partitionBy(F.shiftright("pair", ID_BITS)))
    return counts.select("pair", "docs", (F.col("docs") == most).alias("best"))


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """The rows of texts in ``aligned`` with n_best and count_sum; columns other than those of chunks stay.

    ``aligned`` must be stored, since its chunks are read twice. n_best counts the links
    whose pair no other pair of the same first id exceeds, count_sum adds the pairs' counts over the links.
    """
    places = aligned.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "in_docs")).alias("place", "x"))
    places = places.select("chunk", "place", F.col("x.pairs").alias("pair"))
    replies = places.join(pair_counts(aligned), "pair").select(F.col("chunk").alias("asked"), "place", "docs", "best")
    texts = aligned.where("pairs is null").drop("pairs", "in_docs")
    kept = [c for c in texts.columns if c not in ("chunk", "links")]
    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in kept) + ", n_best long, count_sum long"

    def sums(own: pa.Table, told: pa.Table) -> pa.Table:
        place = told["place"].to_numpy()
        docs, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        docs[place], best[place] = told["docs"].to_numpy(), told["best"].to_numpy()
        n_best, count_sum = [], []
        for links in own["links"].to_pylist():
            at, times = _unpacked(links)
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((times * docs[at]).sum()))
        return own.select(kept).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

    return texts.groupBy("chunk").cogroup(replies.groupBy("asked")).applyInArrow(sums, schema)
