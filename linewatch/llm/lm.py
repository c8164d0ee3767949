"""Scoring by deleted interpolation of bigram, unigram and uniform estimates.

Texts are kept as chunks of token numbers with a dictionary of word hashes. Counts
that a chunk needs are asked for by a shuffle: each chunk sends its distinct words
and bigrams with its own counts to their hash bucket, the bucket adds up what all
chunks sent and answers each with the corpus counts of just its keys. A word in every
document thus costs one key a chunk, whatever its frequency. A chunk never sends more than ``MOST_FAN`` rows:
where there are more buckets, teams of chunks first add up each of ``MOST_FAN`` segments of the keys, ask the buckets
in their chunks' place, and hand the answers on. The mixture weights, one set for
each bucket of context frequency, are learned by expectation-maximisation on the
counts of a held-out part of the training texts, with that part's counts deleted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import bounds, per_run, text_chunks, utf8
from .words import BASE, byte_hashes, lower_ascii, mix, plain_words

CHUNK_TOKENS = 1_000_000
HELD_ONE_IN = 16
CONTEXTS = 32
MOST_ROUNDS = 30
BUCKET_TOKENS = 2_500_000
MOST_FAN = 256
SETTLED = 1e-4
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
CHUNKS = "chunk long, held boolean, n long, words binary, tokens binary, lengths binary, doc_ids binary, known binary, learns binary"
PARTIAL = "chunk long, held boolean, kind int, bucket int, keys binary, counts binary, held_counts binary"
ANSWERS = "chunk long, held boolean, kind int, bucket int, counts binary, held_counts binary"
SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _squeeze(values: np.ndarray) -> bytes:
    """Little-endian values by byte plane, compressed."""
    raw = values.astype(values.dtype.newbyteorder("<")).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(values.dtype.char.encode() + raw.T.tobytes())


def _expand(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    kind = np.dtype(raw[:1].decode())
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, -1, 1).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def _squeeze_sorted(keys: np.ndarray) -> bytes:
    return _squeeze(np.diff(keys, prepend=np.uint64(0)))


def _expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_expand(data), dtype=np.uint64)


def _small(values: np.ndarray) -> np.ndarray:
    """Counts in the narrowest type that holds them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max))


def chunks(docs: DataFrame) -> DataFrame:
    """:data:`CHUNKS` of ``docs`` (doc_id, text, learns, held): held-out texts in chunks of their own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list] = {False: [], True: []}

        def close(held: bool) -> pa.RecordBatch:
            nonlocal number
            parts = waiting[held]
            keys = np.concatenate([p[0] for p in parts])
            lengths, doc_ids, known, learns = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
            tokens, words = pd.factorize(keys)
            order = np.argsort(words)
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            row = [number, held, len(keys), _squeeze_sorted(words[order]), _squeeze(place[tokens]), _squeeze(lengths), _squeeze(doc_ids), _squeeze(known), _squeeze(learns)]
            number += 1
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, [pa.int64(), pa.bool_(), pa.int64(), *[pa.binary()] * 6], strict=True)], [c.split()[0] for c in CHUNKS.split(", ")])

        for batch in text_chunks(batches, "text"):
            flags = batch.column("held").to_numpy(zero_copy_only=False)
            for held in (False, True):
                own = batch.filter(pa.array(flags == held))
                if not own.num_rows:
                    continue
                data, offsets = utf8(own.column("text"))
                data = lower_ascii(data)
                starts, ends, edges = plain_words(data, offsets)
                keys = np.insert(byte_hashes(data, starts, ends), edges[1:], END)
                ids = own.column("doc_id")
                waiting[held].append((keys, np.diff(edges) + 1, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), own.column("learns").to_numpy(zero_copy_only=False).astype(np.uint8)))
                if sum(len(w[0]) for w in waiting[held]) >= CHUNK_TOKENS:
                    yield close(held)
        for held in (False, True):
            if waiting[held]:
                yield close(held)

    return docs.select("doc_id", "text", "learns", "held").mapInArrow(work, CHUNKS)


class Chunk:
    """A chunk's arrays; ``word`` and ``pair`` are each token's places among the sorted keys."""

    def __init__(self, row: dict):
        self.words, self.word, self.lengths = _expand_sorted(row["words"]), _expand(row["tokens"]), _expand(row["lengths"]).astype(np.int64)
        self.doc_ids, self.known, self.learns = _expand(row["doc_ids"]), _expand(row["known"]).astype(bool), _expand(row["learns"]).astype(bool)
        self.edges = bounds(self.lengths)
        key = self.words[self.word]
        before = np.empty_like(key)
        before[1:] = key[:-1]
        before[self.edges[:-1]] = START
        number, pairs = pd.factorize(mix(before * BASE + key))
        order = np.argsort(pairs)
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        self.pairs, self.pair = pairs[order], place[number]
        # the count of a text's start as a context is that of texts, which is that of ends
        self.context = np.empty(len(key), np.int64)
        self.context[1:] = self.word[:-1]
        self.context[self.edges[:-1]] = np.searchsorted(self.words, END)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the chunk's words and pairs."""
        learned = np.repeat(self.learns, self.lengths)
        return np.bincount(self.word[learned], minlength=len(self.words)), np.bincount(self.pair[learned], minlength=len(self.pairs))


def _edges(buckets: int) -> np.ndarray:
    """Where the buckets' ranges of keys begin, but for the first."""
    return (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)


def _split(rows: dict[str, list], head: list, first: int, edges: np.ndarray, keys: np.ndarray, counts: np.ndarray, held: np.ndarray) -> None:
    """Adds a row for each bucket, from ``first`` on, that sorted ``keys`` fall into."""
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False), first):
        if a < b:
            for values, v in zip(rows.values(), [*head, bucket, _squeeze_sorted(keys[a:b]), _squeeze(_small(counts[a:b])), _squeeze(_small(held[a:b]))], strict=True):
                values.append(v)


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


PARTIAL_KINDS = [pa.int64(), pa.bool_(), pa.int32(), pa.int32(), *[pa.binary()] * 3]
ANSWER_KINDS = [pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _summed(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """The keys of each row, all distinct ones in order, and the sums of their counts and held counts."""
    keys = [_expand_sorted(v) for v in table["keys"].to_pylist()]
    which, distinct = pd.factorize(np.concatenate(keys))
    order = np.argsort(distinct)
    sums = []
    for name in ("counts", "held_counts"):
        own = np.concatenate([_expand(v).astype(np.int64) for v in table[name].to_pylist()])
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, which, own)
        sums.append(total[order])
    return keys, distinct[order], sums


def _replies(table: pa.Table, keys: list[np.ndarray], distinct: np.ndarray, sums: list[np.ndarray], tell: bool) -> pa.Table:
    """:data:`ANSWERS` to the rows of ``table``; with ``tell`` a first row of chunk -1 has the totals."""
    out: list[list] = [[], []]
    for own in keys:
        at = np.searchsorted(distinct, own)
        for values, total in zip(out, sums, strict=True):
            values.append(_squeeze(_small(total[at])))
    rows = [table[c].to_pylist() for c in ("chunk", "held", "kind", "bucket")] + out
    if tell:
        totals = _squeeze(np.array([sums[0].sum(), sums[1].sum(), (sums[0] > 0).sum()], np.int64))
        rows = [[f, *r] for f, r in zip([-1, False, table["kind"][0].as_py(), table["bucket"][0].as_py(), totals, b""], rows, strict=True)]
    return pa.table([pa.array(r, k) for r, k in zip(rows, ANSWER_KINDS, strict=True)], names=_columns(ANSWERS))


def answers(stored: DataFrame, buckets: int) -> DataFrame:
    """For each chunk and bucket, or segment, the corpus counts, and the held-out part of them, of the chunk's keys."""
    fan = min(buckets, MOST_FAN)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(fan)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                out: dict[str, list] = {c: [] for c in _columns(PARTIAL)}
                for kind, keys, n in zip((0, 1), (chunk.words, chunk.pairs), chunk.counts(), strict=True):
                    _split(out, [row["chunk"], row["held"], kind], 0, edges, keys, n, n if row["held"] else np.zeros(len(n), np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), PARTIAL_KINDS, strict=True)], list(out))

    def add(table: pa.Table) -> pa.Table:
        return _replies(table, *_summed(table), tell=True)

    asked = stored.mapInArrow(ask, PARTIAL)
    if buckets <= fan:
        return asked.groupBy("bucket", "kind").applyInArrow(add, ANSWERS)
    return _answers_by_teams(asked, fan, math.ceil(buckets / fan), add)


def _answers_by_teams(asked: DataFrame, segments: int, each: int, add) -> DataFrame:
    """The same through teams of chunks, as many as a segment has buckets, so that what a team adds up is a bucket's size."""

    def ask_together(table: pa.Table) -> pa.Table:
        segment, kind, team = (table[c][0].as_py() for c in ("bucket", "kind", "team"))
        _, keys, sums = _summed(table)
        out: dict[str, list] = {c: [] for c in _columns(PARTIAL)}
        edges = _edges(segments * each)[segment * each : (segment + 1) * each - 1]
        _split(out, [team, False, kind], segment * each, edges, keys, *sums)
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), PARTIAL_KINDS, strict=True)], names=list(out))

    def hand_on(asked: pa.Table, told: pa.Table) -> pa.Table:
        keys, distinct, _ = _summed(asked)
        rows = sorted(told.select(["bucket", "counts", "held_counts"]).to_pylist(), key=lambda r: r["bucket"])
        sums = [np.concatenate([_expand(r[c]).astype(np.int64) for r in rows]) for c in ("counts", "held_counts")]
        return _replies(asked, keys, distinct, sums, tell=False)

    asked = staged(asked.withColumn("team", F.pmod(F.xxhash64("chunk"), F.lit(each))), compression="uncompressed")
    told = staged(asked.groupBy("bucket", "kind", "team").applyInArrow(ask_together, PARTIAL).groupBy("bucket", "kind").applyInArrow(add, ANSWERS), compression="uncompressed")
    of_teams = told.where("chunk >= 0").withColumn("segment", F.floor(F.col("bucket") / each).cast("int"))
    handed = asked.groupBy("bucket", "kind", "team").cogroup(of_teams.groupBy("segment", "kind", "chunk")).applyInArrow(hand_on, ANSWERS)
    return told.where("chunk < 0").unionByName(handed)


def _with_answers(stored: DataFrame, replies: DataFrame) -> DataFrame:
    """Chunks and their answers as rows of one table, to be grouped by chunk."""
    return stored.unionByName(replies.where("chunk >= 0"), allowMissingColumns=True)


def _gather(table: pa.Table) -> tuple[Chunk, list[np.ndarray]]:
    """The chunk, and word counts, held word counts, pair counts and held pair counts by key."""
    rows = table.to_pylist()
    chunk = Chunk(next(r for r in rows if r["words"] is not None))
    found = []
    for kind in (0, 1):
        own = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
        found += [np.concatenate([_expand(r[c]).astype(np.int64) for r in own]) for c in ("counts", "held_counts")]
    return chunk, found


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for contexts never met, then one bucket for each doubling of the frequency."""
    return np.where(count > 0, np.minimum(np.floor(np.log2(np.maximum(count, 1))) + 1, CONTEXTS - 1), 0).astype(np.int64)


def events(table: pa.Table, tokens: int, types: int) -> pa.Table:
    """Context bucket and the two estimates of every token of a held-out chunk, its own part deleted."""
    chunk, (word, word_held, pair, pair_held) = _gather(table)
    word, pair = word - word_held, pair - pair_held
    context = word[chunk.context]
    p2 = pair[chunk.pair] / np.maximum(context, 1)
    p1 = word[chunk.word] / max(tokens, 1)
    return pa.table([pa.array([_squeeze(v)], pa.binary()) for v in (context_bucket(context), p2, p1)], names=["context", "p2", "p1"])


def learn_weights(found: DataFrame, types: int) -> np.ndarray:
    """Weights of bigram, unigram and uniform estimate for each context bucket, by EM.

    ``found`` holds the events. A pseudo-event of each kind keeps all weights above
    0; contexts never met have no bigram weight. Ends when no weight moves by more than
    ``SETTLED`` or after ``MOST_ROUNDS``.
    """
    weights = np.full((CONTEXTS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    for _ in range(MOST_ROUNDS):
        now = weights

        def shares(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            total = np.zeros((CONTEXTS, 3))
            for batch in batches:
                for row in batch.to_pylist():
                    context, p2, p1 = (_expand(row[c]) for c in ("context", "p2", "p1"))
                    parts = now[context] * np.stack((p2, p1, np.full(len(p1), 1 / (types + 1))), axis=1)
                    parts /= parts.sum(1, keepdims=True)
                    for i in range(3):
                        total[:, i] += np.bincount(context, parts[:, i], CONTEXTS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CONTEXTS)), *(pa.array(total[:, i]) for i in range(3))], ["context", "a", "b", "c"])

        rows = found.mapInArrow(shares, "context long, a double, b double, c double").groupBy("context").agg(F.sum("a"), F.sum("b"), F.sum("c")).collect()
        sums = np.ones((CONTEXTS, 3))
        sums[0, 0] = 0
        for r in rows:
            sums[r[0]] += r[1:]
        weights = sums / sums.sum(1, keepdims=True)
        if np.abs(weights - now).max() < SETTLED:
            break
    return weights


def scores(table: pa.Table, tokens: int, types: int, weights: np.ndarray) -> pa.Table:
    """:data:`SCORES` of a chunk's texts."""
    chunk, (word, _, pair, _) = _gather(table)
    own, context = word[chunk.word], word[chunk.context]
    w = weights[context_bucket(context)]
    p = w[:, 0] * pair[chunk.pair] / np.maximum(context, 1) + w[:, 1] * own / max(tokens, 1) + w[:, 2] / (types + 1)
    base = np.log10((own + 0.5) / (tokens + 0.5 * (types + 1)))
    edges = chunk.edges
    return pa.table(
        [pa.array(chunk.doc_ids, mask=~chunk.known), pa.array(chunk.lengths), pa.array(per_run((own > 0).astype(np.int64), edges)), pa.array(per_run(base, edges)), pa.array(per_run(np.log10(p), edges))],
        names=[c.split()[0] for c in SCORES.split(", ")],
    )


def score(docs: DataFrame, learns: Column) -> DataFrame:
    """:data:`SCORES` and train_tokens of every row of ``docs`` (doc_id, text).

    Rows for which ``learns`` holds are the training texts, one in ``HELD_ONE_IN`` of them
    (by the hash of the id) the held-out part. Tokens are words in lower case (A-Z)
    and one end a text; a null text is empty. Words and pairs are known by 64-bit
    hashes, dealt into as many buckets as there are shuffle partitions, or one for each
    ``BUCKET_TOKENS`` tokens if those are more, so that a bucket's size is bounded
    under any setting. Texts of any length are counted whole; one longer than a chunk is a chunk of its own. Without training texts all weight lies on the uniform
    estimate. Repeated rows count as often as they stand, an empty table gives no
    row, and other columns may have any name.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    docs = docs.withColumn("held", F.col("learns") & (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(HELD_ONE_IN)) == 0))
    stored = staged(chunks(docs), compression="uncompressed")
    buckets = max(parts, math.ceil(stored.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] / BUCKET_TOKENS))
    replies = staged(answers(stored, buckets), compression="uncompressed")
    told = [_expand(r[0]) for r in replies.where("chunk = -1 and kind = 0").select("counts").collect()]
    tokens, held_tokens, types = (int(sum(t[i] for t in told)) for i in range(3))
    held = _with_answers(stored.where("held"), replies.where("held")).groupBy("chunk").applyInArrow(lambda t: events(t, tokens - held_tokens, types), "context binary, p2 binary, p1 binary")
    weights = learn_weights(staged(held, compression="uncompressed"), types)
    found = _with_answers(stored, replies).groupBy("chunk").applyInArrow(lambda t: scores(t, tokens, types, weights), SCORES)
    return found.withColumn("train_tokens", F.lit(tokens).cast("long"))
