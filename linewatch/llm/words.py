"""Words found and hashed for whole chunks of texts at a time with array operations.

A word's hash is a polynomial over random 64-bit values of its characters, so the
hash of any run of characters comes from two prefix sums. Equal words have equal
hashes; two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
OTHER, LETTER, NUMBER, SPACE = range(4)
_POWERS: dict[str, np.ndarray] = {}


def _powers(kind: str, n: int) -> np.ndarray:
    """Powers of the base or of its inverse, kept for the longest chunk so far."""
    known = _POWERS.get(kind)
    if known is None or len(known) < n:
        step = np.full(max(n, 1 << 16), BASE if kind == "up" else INVERSE, np.uint64)
        step[0] = 1
        known = _POWERS[kind] = np.multiply.accumulate(step)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits; one to one."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@cache
def _random(n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20)).integers(1, 2**64, n, np.uint64)


@cache
def char_kinds() -> np.ndarray:
    """OTHER, LETTER, NUMBER or SPACE for every code point."""
    codes = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))).astype(np.uint32)
    text = codes.tobytes().decode("utf-32-le")
    kinds = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            kinds[codes[m.start() : m.end()]] = kind
    return kinds


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run ``starts[i] .. ends[i]`` of 64-bit ``values``."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers("up", len(values)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers("down", len(values) + 1)[starts])


@cache
def _blank() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes outside 0x20 and 0x09-0x0D: starts, ends, and the edges of each text's words."""
    inside = ~_blank()[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(_random(256)[data], starts, ends)


class Characters:
    """The code points of a chunk of texts, and where each text begins among them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.text = data.tobytes().decode("utf-8", "surrogatepass")
        self.codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(self.codes) == len(data):
            self.offsets = offsets
        else:
            heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            self.offsets = heads[offsets]

    @staticmethod
    def of(texts: list[str]) -> Characters:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        edges = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        return Characters(np.frombuffer(b"".join(raw), np.uint8), edges)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return run_hashes(_random(0x110000)[self.codes], starts, ends)

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kinds = char_kinds()[self.codes]
        opens = np.zeros(len(kinds) + 1, bool)
        opens[self.offsets] = True
        change = opens.copy()
        change[1:-1] |= kinds[1:] != kinds[:-1]
        change[-1] = True
        return kinds, opens, change

    def _cut_contractions(self, first: np.ndarray, kinds: np.ndarray, opens: np.ndarray) -> None:
        """Joins ``'s 't 're 've 'm 'll 'd`` (fixed values of the patterns) to one piece each."""
        n = len(self.codes)
        at = np.flatnonzero((self.codes == 39) & first[:-1])
        at = at[at + 1 < n]
        at = at[(kinds[at + 1] == LETTER) & ~opens[at + 1]]
        one = self.codes[at + 1]
        two = np.where(at + 2 < n, self.codes[np.minimum(at + 2, n - 1)], 0)
        two = np.where(opens[np.minimum(at + 2, n)], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        for which, size in ((short, 2), (long, 3)):
            here = at[which]
            first[here + 1] = False
            after = here + size
            after = after[after < n]
            after = after[(kinds[after] == LETTER) & ~opens[after]]
            first[after] = True

    def spaced_pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces that cover the texts, a word keeping one blank before it.

        As ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
        Returns starts, ends and the edges of each text's pieces.
        """
        n = len(self.codes)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.offsets), np.int64)
        kinds, opens, first = self._runs()
        last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~opens[1:-1])
        first[last] = True
        first[last[self.codes[last] == 32] + 1] = False
        self._cut_contractions(first, kinds, opens)
        edges = np.flatnonzero(first)
        return edges[:-1], edges[1:], np.searchsorted(edges, self.offsets)

    def bare_pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces without white space, every number character alone.

        As ``'s|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+``.
        Returns starts, ends and the edges of each text's pieces.
        """
        n = len(self.codes)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.offsets), np.int64)
        kinds, opens, first = self._runs()
        first[:-1] |= kinds == NUMBER
        self._cut_contractions(first, kinds, opens)
        edges = np.flatnonzero(first)
        starts, ends = edges[:-1], edges[1:]
        word = kinds[starts] != SPACE
        starts, ends = starts[word], ends[word]
        return starts, ends, np.searchsorted(starts, self.offsets)
