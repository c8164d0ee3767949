"""BPE encoding by speculation and verification, and decoding.

For each different word the greedy longest match proposes tokens. A proposal is the
true encoding exactly if every pair of neighbours is: if merging the two tokens'
characters gives these two tokens again. Pairs are looked up for all words at once
in a table of verdicts, which starts anew beyond a size, and only words with a failing pair are merged
step by step. Words are known by hash, so each is worked on once per worker.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import bounds, per_run, ragged, text_chunks, utf8
from .tokens import PieceTable, byte_letters, tokenizer_path
from .words import Characters

CHUNK = 500_000
SHORT = 48
MOST_PAIRS = 2_000_000
NONE = (1 << 60, -1)


class Merges:
    """The merge table of a word-end BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.longest = max(map(len, self.vocab))
        self.letters = byte_letters()
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for i, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[self.vocab[a], self.vocab[b]] = (i, self.vocab[a + b])
        self.text = {i: t for t, i in self.vocab.items()}

    def symbols(self, word: str) -> list[int]:
        """A word of byte letters as one-letter tokens, the last with the word end."""
        return [*(self.vocab[c] for c in word[:-1]), self.vocab[word[-1] + self.end]]

    def token_symbols(self, token: int) -> list[int]:
        text = self.text[token]
        return self.symbols(text[: -len(self.end)]) if text.endswith(self.end) else [self.vocab[c] for c in text]

    def exact(self, symbols: list[int]) -> list[int]:
        """Merges the lowest rank first, the leftmost of equal ones."""
        if len(symbols) <= SHORT:
            return self._exact_short(list(symbols))
        n = len(symbols)
        symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.rank[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in self.rank]
        heap = [(r, i, new, a, b) for r, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i] if symbols[i] == a else n
            if j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new, symbols[k]) in self.rank:
                    r, made = self.rank[new, symbols[k]]
                    heapq.heappush(heap, (r, i, made, new, symbols[k]))
            h = before[i]
            if h >= 0 and (symbols[h], new) in self.rank:
                r, made = self.rank[symbols[h], new]
                heapq.heappush(heap, (r, h, made, symbols[h], new))
        return [s for s in symbols if s >= 0]

    def _exact_short(self, symbols: list[int]) -> list[int]:
        rank = self.rank.get
        ranks = [rank(p, NONE)[0] for p in zip(symbols, symbols[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == NONE[0]:
                break
            i = ranks.index(low)
            symbols[i : i + 2] = [self.rank[symbols[i], symbols[i + 1]][1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), NONE)[0]
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), NONE)[0]
        return symbols

    def greedy(self, word: str) -> list[int]:
        """Longest match from the left; only a token with the word end may close the word."""
        if word + self.end in self.vocab:
            return [self.vocab[word + self.end]]
        vocab, n, i, found = self.vocab, len(word), 0, []
        while i < n:
            if n - i <= self.longest:
                whole = vocab.get(word[i:] + self.end)
                if whole is not None:
                    found.append(whole)
                    break
            j = min(n - 1, i + self.longest)
            while word[i:j] not in vocab:
                j -= 1
            found.append(vocab[word[i:j]])
            i = j
        return found


class SpeculativeBPE(PieceTable):
    """Ids as the tokenizers library gives them with ``add_special_tokens=False``."""

    def __init__(self, path: str):
        super().__init__()
        self.merges = Merges(path)
        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = added
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        size = self.tokenizer.get_vocab_size()
        raw = [(self.tokenizer.id_to_token(i) or "").encode() + b" " for i in range(size)]
        self.token_edges = bounds(np.array([len(r) for r in raw], np.int64))
        self.token_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.pair_codes, self.pair_fine = np.zeros(0, np.int64), np.zeros(0, bool)
        self.own_fine = np.full(size, -1, np.int8)  # 0 or 1 once known
        self.low = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            low = chr(c).lower()
            if len(low) == 1:
                self.low[c] = ord(low)
        self.checked = self.failed = 0

    def _pairs_fine(self, codes: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbours stays when its characters are merged anew."""
        wanted = np.unique(codes)
        if len(self.pair_codes) + len(wanted) > MOST_PAIRS:
            self.pair_codes, self.pair_fine = self.pair_codes[:0], self.pair_fine[:0]
        new = wanted[~np.isin(wanted, self.pair_codes)]
        if len(new):
            merges = self.merges
            fine = [merges.exact(merges.token_symbols(c >> 32) + merges.token_symbols(c & 0xFFFFFFFF)) == [c >> 32, c & 0xFFFFFFFF] for c in new.tolist()]
            at = np.searchsorted(self.pair_codes, new)
            self.pair_codes, self.pair_fine = np.insert(self.pair_codes, at, new), np.insert(self.pair_fine, at, fine)
        return self.pair_fine[np.searchsorted(self.pair_codes, codes)]

    def _alone_fine(self, tokens: np.ndarray) -> np.ndarray:
        """Whether each token is what its characters merge to."""
        new = np.unique(tokens[self.own_fine[tokens] < 0])
        self.own_fine[new] = [self.merges.exact(self.merges.token_symbols(t)) == [t] for t in new.tolist()]
        return self.own_fine[tokens] == 1

    def words(self, words: list[str]) -> list[list[int]]:
        """The ids of words, speculated and verified together."""
        letters = self.merges.letters
        spelled = ["".join([letters[b] for b in w.encode()]) for w in words]
        found = [self.merges.greedy(w) for w in spelled]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for f in found for t in f), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        inner = np.ones(len(flat), bool)
        inner[ends - 1] = False
        at = np.flatnonzero(inner)
        wrong = np.zeros(len(flat), np.int64)
        wrong[at] = ~self._pairs_fine(flat[at] << 32 | flat[at + 1])
        wrong += ~self._alone_fine(flat)
        failing = np.flatnonzero(per_run(wrong, bounds(sizes)))
        for i in failing.tolist():
            found[i] = self.merges.exact(self.merges.symbols(spelled[i]))
        self.checked, self.failed = self.checked + len(found), self.failed + len(failing)
        return found

    def _normal(self, chars: Characters) -> Characters:
        """The texts composed and in lower case, one character at a time."""
        special = (chars.codes == 0x130).any()
        if special or not unicodedata.is_normalized("NFC", chars.text):
            cuts = chars.offsets.tolist()
            return Characters.of([self.tokenizer.normalizer.normalize_str(chars.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
        low = Characters.__new__(Characters)
        low.codes, low.offsets = self.low[chars.codes], chars.offsets
        low.text = low.codes.tobytes().decode("utf-32-le", "surrogatepass")
        return low

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the n + 1 edges of each text's ids."""
        chars = Characters(*utf8(column))
        if any(a in chars.text for a in self.added):
            return self._with_added(chars)
        chars = self._normal(chars)
        starts, ends, edges = chars.bare_pieces()
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(chars.offsets), np.int64)
        which, keys = pd.factorize(chars.hashes(starts, ends))
        at = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
        place = self.places(keys, lambda new: self.words([chars.text[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]))[which]
        ids, sizes = self.gather(place)
        return ids, bounds(sizes)[edges]

    def _with_added(self, chars: Characters) -> tuple[np.ndarray, np.ndarray]:
        cuts = chars.offsets.tolist()
        found = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            pieces = self.split.split(chars.text[a:b])
            parts = [np.array([self.added[p]], np.uint32) if i % 2 else self.encode(pa.array([p]))[0] for i, p in enumerate(pieces)]
            found.append(np.concatenate(parts).astype(np.uint32))
        return np.concatenate(found), bounds(np.array([len(f) for f in found], np.int64))

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """The texts of runs of ids: their tokens joined by blanks, as a file without decoder has it."""
        sizes = self.token_edges[ids + 1] - self.token_edges[ids]
        data = self.token_bytes[ragged(self.token_edges[ids], sizes)]
        total = bounds(sizes)
        keep = np.ones(len(data), bool)
        keep[total[edges[1:][np.diff(edges) > 0]] - 1] = False  # the blank after each text's last token
        filled = np.diff(edges) > 0
        out_edges = total[edges] - np.concatenate(([0], np.cumsum(filled)))
        return pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(out_edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[keep]))]).cast(pa.string())


@cache
def speculative(path: str) -> SpeculativeBPE:
    return SpeculativeBPE(path)


def encode_decode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded text of every row of ``docs`` (doc_id, text).

    Ids are those of the tokenizers library without special tokens added; strings of
    the file's added tokens in a text give their ids. A null text is empty: no ids
    and an empty decoded text. Repeated rows stay, an empty table gives no row, and
    other columns may have any name.
    """
    tokenizer = tokenizer or tokenizer_path("word_bpe_49k.json")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = speculative(tokenizer)
        for batch in text_chunks(batches, "text", CHUNK):
            ids, edges = bpe.encode(batch.column("text"))
            arrays = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), arrays, bpe.decode(ids, edges)], ["doc_id", "ids", "decoded"])

    return docs.mapInArrow(work, "doc_id long, ids array<int>, decoded string")
