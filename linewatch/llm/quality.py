"""Quality rules: counts of each text and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted, one over a trusted sample
and one over the whole corpus. A document's score is the sum over its n-grams of
the log ratio of the two, divided by their number; documents below a fixed
threshold go. The ratio is near 0.1 for text like the trusted one and far below 0
for n-grams that the trusted texts lack.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_run, text_chunks, utf8
from .words import BASE, byte_hashes, mix, plain_words

WIDTH = 3
BUCKET_BITS = 16
TRUSTED_ROWS = 20_000
LEAST_RATIO = -0.3
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash bucket of every byte n-gram, and the edges of each text's n-grams."""
    n = max(0, len(data) - WIDTH + 1)
    code = np.zeros(n, np.uint64)
    for i in range(WIDTH):
        code = code << np.uint64(8) | data[i : i + n]
    bucket = (code * BASE >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    inside = np.ones(n, bool)
    for i in range(1, WIDTH):
        cut = offsets[1:-1] - i
        inside[cut[(cut >= 0) & (cut < n)]] = False
    places = np.flatnonzero(inside)
    return bucket[places], np.searchsorted(places, offsets)


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """:data:`COUNTS` of each text."""
    texts = len(offsets) - 1
    starts, ends, edges = plain_words(data, offsets)
    heads = (data & 0xC0) != 0x80
    word_chars = np.concatenate(([0], np.cumsum(heads)))
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    found = {"n_words": np.diff(edges), "word_chars": per_run(word_chars[ends] - word_chars[starts], edges), "n_symbols": per_run(symbol[data].astype(np.int64), offsets)}

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
    line_ends = np.sort(np.concatenate((offsets[1:], breaks)))
    owner = np.searchsorted(offsets[1:], line_ends, side="left")
    words_before = np.searchsorted(starts, line_ends) - np.searchsorted(starts, line_starts)
    real = words_before > 0
    line_starts, line_ends, owner = line_starts[real], line_ends[real], owner[real]
    keys = mix(byte_hashes(data, line_starts, line_ends) + owner.astype(np.uint64) * BASE)
    found["n_dup_lines"] = np.bincount(owner[pd.Series(keys).duplicated().to_numpy()], minlength=texts)

    word = byte_hashes(data, starts, ends)
    n = max(0, len(word) - WINDOW + 1)
    window = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        window = window * BASE + word[i : i + n]
    owner = np.repeat(np.arange(texts), np.diff(edges))
    whole = owner[:n] == owner[WINDOW - 1 : WINDOW - 1 + n] if n else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    keys = mix(window[at] + owner[at].astype(np.uint64) * BASE)
    at = at[pd.Series(keys).duplicated(keep=False).to_numpy()]
    turn = np.bincount(at, minlength=len(word) + 1) - np.bincount(at + WINDOW, minlength=len(word) + 1)
    found["n_repeat_words"] = per_run((np.cumsum(turn)[: len(word)] > 0).astype(np.int64), edges)
    return found


def log_ratios(docs: DataFrame, trusted_ids: np.ndarray) -> np.ndarray:
    """The log ratio of every hash bucket, trusted against all ``docs`` (doc_id, text).

    Counts run over whole texts of all rows; each task sends one row per bucket it has met.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in text_chunks(batches, "text"):
            found, edges = buckets(*utf8(batch.column("text")))
            total[0] += np.bincount(found, minlength=1 << BUCKET_BITS)
            ids = batch.column("doc_id")
            chosen = np.isin(ids.fill_null(0).to_numpy(), trusted_ids) & ids.is_valid().to_numpy(zero_copy_only=False)
            if chosen.any():
                total[1] += np.bincount(found[np.repeat(chosen, np.diff(edges))], minlength=1 << BUCKET_BITS)
        met = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[0][met]), pa.array(total[1][met])], ["bucket", "n", "trusted"])

    sums = docs.select("doc_id", "text").mapInArrow(work, "bucket long, n long, trusted long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("trusted").alias("trusted"))
    table = np.zeros((2, 1 << BUCKET_BITS))
    for r in sums.collect():
        table[:, r["bucket"]] = r["n"], r["trusted"]
    if not table[1].any():
        return np.zeros(1 << BUCKET_BITS)
    raw, trusted = ((t + 1) / (t.sum() + len(t)) for t in table)
    return np.log(trusted / raw)


def trusted_sample(labels: DataFrame) -> np.ndarray:
    """Ids of at most ``TRUSTED_ROWS`` documents labelled good, those of the smallest hash."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return np.sort(np.array([r[0] for r in good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED_ROWS).collect()], np.int64))


def judge(column: pa.Array, ratios: np.ndarray) -> dict[str, np.ndarray]:
    """Counts, ``base_failed``, ``ratio`` and ``kept`` of each text."""
    data, offsets = utf8(column)
    found = counts(data, offsets)
    bucket, edges = buckets(data, offsets)
    total = per_run(ratios[bucket], edges)
    found["ratio"] = total / np.maximum(1, np.diff(edges))
    found["base_failed"] = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
    found["kept"] = ~found["base_failed"] & (found["ratio"] >= LEAST_RATIO)
    return found


def _typed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, :data:`COUNTS`, base_failed, kept and ratio of every row of ``docs``.

    ``labels`` has doc_id and quality; ids labelled 1 are the trusted texts, at most
    ``TRUSTED_ROWS`` of them. Without any the ratio is 0 and the counts alone
    decide. A null or empty text has no words and fails. Repeated rows stay, a null
    ``doc_id`` is never trusted, an empty table gives no row, and other columns may
    have any name.
    """
    docs = _typed(docs)
    ratios = log_ratios(docs, trusted_sample(labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            found = judge(batch.column("text"), ratios)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[c]) for c in [*COUNTS, "base_failed", "kept", "ratio"])], ["doc_id", *COUNTS, "base_failed", "kept", "ratio"])

    return docs.mapInArrow(work, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, ratio double")


def is_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> Column:
    """The verdict on a row of ``docs`` as a condition, whatever other columns it has."""
    ratios = log_ratios(_typed(docs), trusted_sample(labels))

    @F.arrow_udf("boolean")
    def good(column: pa.Array) -> pa.Array:
        parts = [judge(b.column(0), ratios)["kept"] for b in text_chunks([pa.RecordBatch.from_arrays([column], ["t"])], "t")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return good(F.col(text).cast("string"))
