"""Language identification with a bit-sliced Bloom filter of n-grams.

Each position of the filter holds a mask with one bit a language, in words of 64; the masks of an
n-gram's positions, and-ed, name all languages whose n-grams contain it. A text's
masks are counted bit by bit, each count is corrected for the false positives that
its language's fill predicts, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import per_run, ragged, text_chunks, utf8
from .words import LETTER, Characters, char_kinds, mix

POSITIONS = 1 << 20
HASHES = 3
LEAST_RATE = 1e-5
WITHIN = 4.0
WORD_BITS = 64
RUN = 128
QUANTILE = 0.01
OF_QUANTILE = 0.8
DEVIATIONS = 3.0
BINS = 1000
FLUSH = 250_000
UNKNOWN = "und"


@cache
def _lower() -> np.ndarray:
    """Each letter's lower case, where that is one character; every other character is a blank."""
    table = np.full(0x110000, 32, np.int64)
    for c in np.flatnonzero(char_kinds() == LETTER).tolist():
        low = chr(c).lower()
        table[c] = ord(low) if len(low) == 1 else c
    return table


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One code for each letter, made of it and its neighbours, and the edges of each text's codes."""
    chars = Characters(*utf8(column))
    low = _lower()[chars.codes]
    n = len(low)
    left, right = np.full(n, 32, np.int64), np.full(n, 32, np.int64)
    left[1:], right[:-1] = low[:-1], low[1:]
    heads = chars.offsets[:-1]
    left[heads[heads < n]] = 32
    tails = chars.offsets[1:] - 1
    right[tails[tails >= 0]] = 32
    at = np.flatnonzero(char_kinds()[chars.codes] == LETTER)
    return (left << 42 | low << 21 | right)[at], np.searchsorted(at, chars.offsets)


@dataclass
class Filter:
    """The languages, their masks by word and position, and each language's false-positive rate."""

    languages: list[str]
    masks: np.ndarray
    false: np.ndarray

    @staticmethod
    def positions(codes: np.ndarray) -> np.ndarray:
        """A row of positions for each hash."""
        h = mix(codes.astype(np.uint64))
        step = mix(h) | np.uint64(1)
        return np.stack([((h + np.uint64(i) * step) % np.uint64(POSITIONS)).astype(np.int64) for i in range(HASHES)])

    @staticmethod
    def build(languages: list[str], owner: np.ndarray, codes: np.ndarray) -> Filter:
        kind = next((k for k, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(languages) <= bits), np.uint64)
        masks = np.zeros((max(1, -(-len(languages) // WORD_BITS)), POSITIONS), kind)
        bits = (np.uint64(1) << (owner % WORD_BITS).astype(np.uint64)).astype(kind)
        for row in Filter.positions(codes):
            np.bitwise_or.at(masks, (owner // WORD_BITS, row), bits)
        fill = [Filter._bit(masks, i).mean() for i in range(len(languages))]
        return Filter(languages, masks, np.array(fill) ** HASHES)

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return masks[i // WORD_BITS] >> masks.dtype.type(i % WORD_BITS) & masks.dtype.type(1)

    def containing(self, codes: np.ndarray) -> np.ndarray:
        """A row of masks for each word."""
        at = self.positions(codes)
        return np.stack([np.bitwise_and.reduce(word[at], axis=0) for word in self.masks])

    def _counts(self, codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """A row for each language: its corrected counts of n-grams between neighbouring ``edges``."""
        which, distinct = pd.factorize(codes)
        masks = self.containing(distinct)
        counts = np.stack([per_run(self._bit(masks, i)[which].astype(np.int64), edges) for i in range(len(self.languages))])
        return (counts - np.diff(edges) * self.false[:, None]) / (1 - self.false[:, None])

    def fit(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each text's best language, the share of its n-grams in learned languages, and their number.

        Each run of ``RUN`` n-grams counts in its own best language, so a text that
        mixes learned languages fits as well as one in a single of them.
        """
        codes, edges = ngrams(column)
        n = np.diff(edges)
        if not self.languages or not len(codes):
            return np.zeros(len(n), np.int64), np.zeros(len(n)), n
        runs = -(-n // RUN)
        owner = np.repeat(np.arange(len(n)), runs)
        heads = edges[owner] + RUN * ragged(np.zeros(len(n), np.int64), runs)
        counts = self._counts(codes, np.append(heads, len(codes)))
        best = np.stack([np.bincount(owner, c, len(n)) for c in counts]).argmax(0)
        return best, np.clip(np.bincount(owner, counts.max(0), len(n)) / np.maximum(n, 1), 0.0, 1.0), n

    def predict(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The language of each text and its corrected share of the n-grams."""
        codes, edges = ngrams(column)
        n = np.diff(edges)
        if not self.languages or not len(codes):
            return pa.array([UNKNOWN] * len(n), pa.string()), np.zeros(len(n))
        corrected = self._counts(codes, edges)
        best = corrected.argmax(0)
        score = np.clip(corrected.max(0) / np.maximum(n, 1), 0.0, 1.0)
        names = pa.array([*self.languages, UNKNOWN]).take(pa.array(np.where(n > 0, best, len(self.languages))))
        return names, np.where(n > 0, score, 0.0)


def learn(docs: DataFrame) -> Filter:
    """The filter of ``docs`` (text, lang); rows without a language teach nothing.

    A language contains an n-gram that makes up at least ``LEAST_RATE`` of its n-grams and
    is at most ``WITHIN`` times rarer in it than where it is most frequent: a choice
    by rates, alike at every size, with at most 1 / ``LEAST_RATE`` n-grams a language.
    The filter grows by 8 MB with every ``WORD_BITS`` languages.
    """
    docs = docs.where("lang is not null").select("lang", F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            total = pd.concat(held).groupby(["lang", "code"], as_index=False)["n"].sum()
            held, size = [total], len(total)
            return pa.RecordBatch.from_pandas(total, preserve_index=False)

        for batch in text_chunks(batches, "text"):
            codes, edges = ngrams(batch.column("text"))
            langs = batch.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            which, distinct = pd.factorize(codes)
            cell = which * len(names) + np.repeat(langs.indices.to_numpy(), np.diff(edges))
            counts = np.bincount(cell, minlength=len(distinct) * len(names))
            met = np.flatnonzero(counts)
            held.append(pd.DataFrame({"lang": pd.Categorical.from_codes(met % len(names), names).astype(str), "code": distinct[met // len(names)], "n": counts[met]}))
            size += len(met)
            if size > FLUSH:
                out = flush()
                if size > FLUSH // 2:
                    yield out
                    held, size = [], 0
        if held:
            yield flush()

    sums = docs.mapInArrow(work, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    sums = staged(sums)
    totals = {r["lang"]: r["n"] for r in sums.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Filter([], np.zeros((1, POSITIONS), np.uint8), np.zeros(0))
    whole = F.element_at(F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(float(totals[k]))))), F.col("lang"))
    rates = sums.withColumn("rate", F.col("n") / whole).where(F.col("rate") >= LEAST_RATE)
    most = rates.groupBy("code").agg(F.max("rate").alias("most"))
    chosen = rates.join(most, "code").where(F.col("rate") * WITHIN >= F.col("most")).select("lang", "code").collect()
    place = {k: i for i, k in enumerate(languages)}
    return Filter.build(languages, np.array([place[r[0]] for r in chosen], np.int64), np.array([r[1] for r in chosen], np.int64))


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs`` (doc_id, text).

    ``und`` with score 0 for a null text or one without letters; a tie goes to the first
    language by name. Nothing but the text is looked at. Repeated rows stay, and
    an empty table gives no row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            names, score = model.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), names, pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(work, "doc_id long, lang_pred string, score double")


def least_shares(docs: DataFrame, model: Filter) -> np.ndarray:
    """The share that a text needs to count as each of the model's languages, from ``docs`` (text, lang).

    ``OF_QUANTILE`` of the ``QUANTILE`` of the shares that texts labelled with the language
    have; each task sends at most ``BINS`` + 1 counts a language.
    """
    place = {k: i for i, k in enumerate(model.languages)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros((len(place), BINS + 1), np.int64)
        for batch in text_chunks(batches, "text"):
            _, share, n = model.fit(batch.column("text"))
            own = np.array([place.get(k, -1) for k in batch.column("lang").to_pylist()])
            real = (own >= 0) & (n > 0)
            np.add.at(bins, (own[real], (share[real] * BINS).astype(np.int64)), 1)
        met = np.nonzero(bins)
        yield pa.RecordBatch.from_arrays([pa.array(met[0]), pa.array(met[1]), pa.array(bins[met])], ["place", "bin", "n"])

    docs = docs.where("lang is not null").select("lang", F.col("text").cast("string").alias("text"))
    bins = np.zeros((len(place), BINS + 1), np.int64)
    for r in docs.mapInArrow(work, "place long, bin long, n long").groupBy("place", "bin").agg(F.sum("n").alias("n")).collect():
        bins[r["place"], r["bin"]] = r["n"]
    return np.array([np.searchsorted(np.cumsum(b), QUANTILE * b.sum(), side="right") for b in bins]) / BINS * OF_QUANTILE


def is_known(model: Filter, text: str = "text", least: np.ndarray | None = None) -> Column:
    """Whether a row's text is in learned languages: its share reaches its best language's ``least``.

    A text of n n-grams may fall short by ``DEVIATIONS`` standard deviations of a share of n,
    so that short ones aren't lost by chance. Without ``least`` every text with a letter passes.
    """
    least = np.zeros(len(model.languages)) if least is None else least
    learned = bool(model.languages)

    @F.arrow_udf("boolean")
    def known(column: pa.Array) -> pa.Array:
        parts = []
        for b in text_chunks([pa.RecordBatch.from_arrays([column], ["t"])], "t"):
            best, share, n = model.fit(b.column(0))
            need = least[best] if learned else np.zeros(len(n))
            slack = DEVIATIONS * np.sqrt(need * (1 - need) / np.maximum(n, 1))
            parts.append((n > 0) & learned & (share >= need - slack))
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return known(F.col(text).cast("string"))
