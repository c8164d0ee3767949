"""Maximal periodic runs of words, found by catching squares as words are appended.

Words are appended to a stream in batches. Every completed block of 2**k words, begun at a
multiple of 2**k, is guarded by a catcher until 4 * 2**k words follow its start: each
appended word compares the 2**k last words with the two blocks that began 2 to 4
times 2**k words before them. Equal ones prove that the words between repeat with that distance; any square
with a period of 2 * 2**k to 4 * 2**k words holds such a block in its first half. What is caught is
extended both ways by doubling steps, which gives a square or nothing, and
squares of the same words merge into one run. Runs of words have names by
hash, each made from its halves', so a comparison is one of two numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounds, ragged, text_chunks, utf8
from .words import byte_hashes, mix, plain_words

LEAST_LENGTH = 12
BATCH = 1 << 18  # words appended at once
HASHED = 1 << 22  # bytes of words hashed at once
LEFT, RIGHT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
TURN, BACK = np.uint64(23), np.uint64(41)

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a run of words from the names of its halves."""
    return mix(a * LEFT + ((b << TURN) | (b >> BACK)) * RIGHT)


class SquareCatcher:
    """The runs of a stream of words, given as 64-bit names in batches.

    ``longest`` may tell that no square can hold more words, as separators between texts never match.
    """

    def __init__(self, least: int = LEAST_LENGTH, longest: int | None = None) -> None:
        self.least, self.longest = least, longest
        self.size = 0
        self.names = [np.zeros(1 << 10, np.uint64)]  # [k][s]: the 2**k words from s on
        self.open = np.zeros((0, 2), np.int64)  # first word and period of repetitions that the last word prolongs
        self.caught: list[np.ndarray] = []  # first word, word after the last, period

    def _name(self, words: np.ndarray) -> None:
        """Names of all blocks that end with a new word, level by level."""
        old, n = self.size, self.size + len(words)
        self.size = n
        room = len(self.names[0])
        while room < n:
            room *= 2
        self.names = [np.concatenate((x, np.zeros(room - len(x), np.uint64))) for x in self.names] if room > len(self.names[0]) else self.names
        self.names[0][old:n] = words
        k, most = 0, n if self.longest is None else min(n, self.longest)
        while 8 << k <= most:  # the squares of level k have 4 << k words at least
            half, m = self.names[k], 1 << k
            new = k + 1 == len(self.names)
            if new:
                self.names.append(np.zeros(room, np.uint64))
            a, b = 0 if new else max(0, old - 2 * m + 1), n - 2 * m + 1
            self.names[k + 1][a:b] = _pair(half[a:b], half[a + m : b + m])
            k += 1

    def append(self, words: np.ndarray) -> None:
        """Adds words, catches the squares that they complete, and prolongs the open repetitions."""
        old, levels = self.size, len(self.names)
        self._name(words)
        n, found = self.size, [self.open]
        first = max(1, old)
        near = np.flatnonzero(self.names[0][first:n] == self.names[0][first - 1 : n - 1]) + first - 1
        found.append(self._heads(near, np.ones(len(near), np.int64), 0))
        for k, names in enumerate(self.names):
            m = 1 << k
            a, b = max(2 * m, old - m + 1 if k < levels else 0), n - m + 1  # suffixes that end with a new word
            if a >= b:
                continue
            at = np.arange(a, b)
            block = ((at >> k) - 2) << k
            for _ in range(2):
                hit = np.flatnonzero(names[np.maximum(block, 0)] == names[a:b])
                hit = hit[block[hit] >= 0]
                found.append(self._heads(block[hit], at[hit] - block[hit], k))
                block = block - m
        self._extend(np.concatenate(found))

    def _heads(self, start: np.ndarray, period: np.ndarray, level: int) -> np.ndarray:
        """Catches whose block before is no catch with the same period: the others lie in what that one's extension covers."""
        names, before = self.names[level], start - (1 << level)
        known = (before >= 0) & (names[np.maximum(before, 0)] == names[np.maximum(before + period, 0)])
        return np.stack((start[~known], period[~known]), axis=1)

    def _step(self, start: np.ndarray, end: np.ndarray, period: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        m, names = 1 << level, self.names[level]
        back = start - m
        left = back >= 0
        left[left] = names[back[left]] == names[back[left] + period[left]]
        right = end + period + m <= self.size
        right[right] = names[end[right]] == names[end[right] + period[right]]
        return np.where(left, back, start), np.where(right, end + m, end)

    def _extend(self, catches: np.ndarray) -> None:
        """Catches made as long as they go; those that reach the last word stay open."""
        period = catches[:, 1]
        start = end = catches[:, 0]  # words start .. end - 1 equal those one period on
        top = len(self.names) - 1
        moving = np.arange(len(catches))
        while len(moving):  # top steps until none can go on, then one of each smaller size
            left, right = self._step(start[moving], end[moving], period[moving], top)
            moved = (left < start[moving]) | (right > end[moving])
            start, end = start.copy(), end.copy()
            start[moving], end[moving] = left, right
            moving = moving[moved]
        for k in range(top - 1, -1, -1):
            start, end = self._step(start, end, period, k)
        reach = end + period
        goes_on = reach == self.size
        self.open = np.stack((start, period), axis=1)[goes_on]
        self.caught.append(np.stack((start, reach, period), axis=1)[~goes_on & self._is_run(start, reach, period)])

    def _is_run(self, start: np.ndarray, reach: np.ndarray, period: np.ndarray) -> np.ndarray:
        return reach - start >= np.maximum(2 * period, self.least)

    def finish(self) -> np.ndarray:
        """All runs of at least ``least`` words by start and period: first word, word after the last, smallest period."""
        start, period = self.open.T
        reach = np.full(len(start), self.size)
        found = np.concatenate((*self.caught, np.stack((start, reach, period), axis=1)[self._is_run(start, reach, period)], np.zeros((0, 3), np.int64)))
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        first = np.ones(len(found), bool)  # squares merge: longer periods of the same words are multiples of the smallest
        first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
        found = found[first]
        return found[np.lexsort((found[:, 2], found[:, 0]))]


def _word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the words, some million bytes of text at a time."""
    at = 0
    while at < len(starts):
        to = max(at + 1, min(at + BATCH, int(np.searchsorted(ends, starts[at] + HASHED, side="right"))))
        a, b = starts[at], ends[to - 1]
        yield byte_hashes(data[a:b], starts[at:to] - a, ends[at:to] - a)
        at = to


def runs_of(data: np.ndarray, offsets: np.ndarray, least: int = LEAST_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words and runs of a chunk of texts.

    Returns the words' first bytes and ends, the edges of each text's words, and the
    runs: first word and word after the last among all words, and period.
    """
    starts, ends, edges = plain_words(data, offsets)
    counts = np.diff(edges)
    text = np.repeat(np.arange(len(counts)), counts)
    catcher = SquareCatcher(least, int(counts.max(initial=0)))
    at = 0
    for names in _word_names(data, starts, ends):
        # each text ends with a name that no other place has, so no square crosses two texts
        of, after = text[at : at + len(names)], np.r_[text[at + 1 : at + len(names) + 1], -1][: len(names)]
        last = np.flatnonzero(of != after)
        catcher.append(np.insert(names, last + 1, mix(np.uint64(0xA5A5) + of[last].astype(np.uint64))))
        at += len(names)
    runs = catcher.finish()
    filled = np.flatnonzero(counts)  # texts without words have no separator
    heads = edges[filled] + np.arange(len(filled))  # the first word of each text in the stream
    before = np.searchsorted(heads, runs[:, 0], side="right") - 1
    runs[:, :2] -= before[:, None]
    return starts, ends, edges, runs


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, edges: np.ndarray, runs: np.ndarray) -> pa.Array:
    """The words of each text that no run repeats, joined by one space."""
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    sizes = np.where(kept, ends - starts + 1, 0)
    total = bounds(sizes)
    out = np.empty(int(total[-1]), np.uint8)
    which = np.flatnonzero(kept)
    at = 0
    while at < len(which):
        to = max(at + 1, int(np.searchsorted(ends[which], starts[which[at]] + HASHED, side="right")))
        w = which[at:to]
        part = data[np.minimum(ragged(starts[w], sizes[w]), len(data) - 1)]
        part[np.cumsum(sizes[w]) - 1] = 0x20
        out[total[w[0]] : total[w[-1]] + sizes[w[-1]]] = part
        at = to
    text_edges = total[edges]
    full = text_edges[1:] > text_edges[:-1]
    out = np.delete(out, text_edges[1:][full] - 1)  # the space after each text's last word
    text_edges = text_edges - np.concatenate(([0], np.cumsum(full)))
    return pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(text_edges.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())


def find_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """:data:`RUNS` of every row of ``docs`` (doc_id, text).

    Words are runs of characters outside 0x20 and 0x09-0x0D, numbered from 0. A run is a stretch
    of at least ``least`` words and of twice its smallest period, at which its words repeat, that no word beside it prolongs; runs stand by
    start, then period, and may overlap. ``collapsed`` joins by one space the words that no run
    holds after its first period. A null or empty text has no word, no run and an empty collapsed
    text; a text of any length is searched whole, in memory of about eight bytes a word and level of blocks. Repeated rows and a
    null doc_id are rows like others, an empty table gives no row, and other columns may have any name.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            starts, ends, edges, runs = runs_of(data, offsets, least)
            collapsed = _collapsed(data, starts, ends, edges, runs)
            owner = np.searchsorted(edges, runs[:, 0], side="right") - 1
            each = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            kinds = [pa.array(c) for c in (runs[:, 0] - edges[owner], runs[:, 1] - runs[:, 0], runs[:, 2])]
            found = pa.ListArray.from_arrays(pa.array(each.astype(np.int32)), pa.StructArray.from_arrays(kinds, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(edges).astype(np.int64)), found, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.mapInArrow(work, RUNS)
