"""Ids of a public tokenizer for whole chunks of texts.

Texts are cut into the tokenizer's own pieces with array operations, and each
different piece is merged once per worker: a piece's ids do not depend on its
neighbours. Pieces are merged by tiktoken with the ranks of the tokenizer file,
which gives the same ids as the tokenizers library at a tenth of the time; files
whose merges are no such ranks, and texts that hold the string of an added token,
are left to the tokenizers library.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from .common import bounds, ragged, utf8
from .words import Characters

MOST_PIECES = 500_000
MOST_IDS = 16_000_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes of each token and its id, if the ids are in the order of the merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    back = {c: b for b, c in enumerate(byte_letters())}
    if model.get("end_of_word_suffix") or not set(back) <= set(vocab):
        return None
    first = len(back)
    if sorted(vocab[c] for c in back) != list(range(first)) or any(vocab.get(a + b) != first + i for i, (a, b) in enumerate(merges)):
        return None
    return {bytes(back[c] for c in token): i for token, i in vocab.items() if i < first + len(merges)}


class PieceTable:
    """Ids of pieces by the pieces' hashes; started anew beyond ``MOST_PIECES`` pieces or ``MOST_IDS`` ids."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes of the pieces met so far
        self.place = np.zeros(0, np.int32)  # and the number of each
        self.ids = np.zeros(1 << 16, np.uint32)
        self.edges = np.zeros(1 << 16, np.int64)

    def _add(self, keys: np.ndarray, new: list[list[int]]) -> None:
        n = len(self.known)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        ends = self.edges[n] + np.cumsum(sizes)
        while len(self.edges) < n + len(new) + 1:
            self.edges = np.concatenate((self.edges, np.zeros_like(self.edges)))
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.edges[n] : ends[-1]] = np.fromiter((i for e in new for i in e), np.uint32, int(sizes.sum()))
        self.edges[n + 1 : n + 1 + len(new)] = ends
        order = np.argsort(keys)
        at = np.searchsorted(self.known, keys[order])
        self.known = np.insert(self.known, at, keys[order])
        self.place = np.insert(self.place, at, (n + order).astype(np.int32))

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for new ones."""
        if not len(self.known):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.where(self.known[at] == keys, self.place[at], -1)

    def places(self, keys: np.ndarray, encode: Callable[[np.ndarray], list[list[int]]]) -> np.ndarray:
        """The numbers of distinct pieces; ``encode`` gets the positions of those not met yet."""
        if len(self.known) + len(keys) > MOST_PIECES or self.edges[len(self.known)] > MOST_IDS:
            self._forget()
        found = self._find(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            self._add(keys[new], encode(new))
            found = self._find(keys)
        return found

    def gather(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in a row, and each piece's number of ids."""
        sizes = self.edges[place + 1] - self.edges[place]
        return self.ids[ragged(self.edges[place], sizes)], sizes


class Encoder(PieceTable):
    """Byte-level BPE as the library does it with ``add_special_tokens=False``."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = merge_ranks(path)
        self.merge = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece if ranks else None

    def _merged(self, pieces: list[str]) -> list[list[int]]:
        if self.merge:
            return [self.merge(p.encode()) for p in pieces]
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the n + 1 edges of each text's ids."""
        data, offsets = utf8(column)
        chars = Characters(data, offsets)
        if any(a in chars.text for a in self.added):
            return self._with_added(chars)
        starts, ends, edges = chars.spaced_pieces()
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        which, keys = pd.factorize(chars.hashes(starts, ends))
        at = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
        place = self.places(keys, lambda new: self._merged([chars.text[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]))[which]
        ids, sizes = self.gather(place)
        return ids, bounds(sizes)[edges]

    def _with_added(self, chars: Characters) -> tuple[np.ndarray, np.ndarray]:
        cuts = chars.offsets.tolist()
        found = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            text = chars.text[a:b]
            if any(x in text for x in self.added):
                found.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
            else:
                found.append(self.encode(pa.array([text]))[0])
        return np.concatenate(found).astype(np.uint32), bounds(np.array([len(f) for f in found], np.int64))


@cache
def encoder(path: str) -> Encoder:
    """One per worker and file, so that pieces seen in earlier tasks stay known."""
    return Encoder(path)
