"""Re-Pair grammar compression of token ids, shard by shard.

A shard is one binary value; :func:`decode` reads any run of its ids without
expanding the rest. Layout (little-endian):

| field | type |
| --- | --- |
| magic ``RPR1`` | 4 bytes |
| base, rules, symbols, documents | 4 x uint64 |
| left and right symbol of each rule | 2 x rules x uint32 |
| expansion length of each rule | rules x uint32 |
| ids of each document | documents x uint64 |
| symbols | symbols x uint16, or uint32 if base + rules needs it |

Symbols below ``base`` are ids, ``base + i`` is rule ``i``, which uses smaller symbols only.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binaries, bounds, text_chunks
from .tokens import encoder, tokenizer_path

MAGIC = b"RPR1"
SHARD_IDS = 1_000_000
ROUNDS = 12
LEAST_COUNT = 16
LEAST_SAVING = 0.01
HASH_BITS = 18
SHARDS = "part int, shard int, start long, n_ids long, doc_ids binary, known binary, data binary"


def _hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - HASH_BITS)


def _frequent_pairs(symbols: np.ndarray, inner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that may be frequent, and their codes; a first count by hash rules out the rest."""
    bins = _hash(symbols[:-1], symbols[1:])
    counts = np.bincount(bins, minlength=1 << HASH_BITS)
    at = np.flatnonzero((counts >= least)[bins] & inner)
    return at, symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]


def compress(ids: np.ndarray, base: int, most_rules: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, left and right of each rule, and expansion lengths.

    Each round counts all adjacent pairs, gives a rule to every pair found at least
    ``LEAST_COUNT`` times and within a factor of 64 of the most frequent, and replaces
    their occurrences from left to right; of overlapping ones the first counts.
    """
    most_rules = (1 << 16) - base if most_rules is None else most_rules
    symbols = ids.astype(np.uint32)
    left, right, sizes = [np.zeros(0, np.uint32)] * 3
    for _ in range(ROUNDS):
        if len(symbols) < 2 or len(left) >= most_rules:
            break
        at, codes = _frequent_pairs(symbols, np.ones(len(symbols) - 1, bool), LEAST_COUNT)
        if not len(at):
            break
        number, pairs = pd.factorize(codes)
        counts = np.bincount(number, minlength=len(pairs))
        room = most_rules - len(left)
        chosen = np.flatnonzero(counts >= max(LEAST_COUNT, counts.max() // 64))
        chosen = chosen[np.lexsort((pairs[chosen], -counts[chosen]))][:room]
        rule = np.full(len(pairs), -1, np.int64)
        rule[chosen] = np.arange(len(chosen))
        hit = rule[number] >= 0
        at, number = at[hit], rule[number[hit]]
        # in a run of overlapping occurrences every second one stays
        opens = np.diff(at, prepend=-2) != 1
        where = np.arange(len(at))
        keep = (where - np.maximum.accumulate(np.where(opens, where, 0))) % 2 == 0
        at, number = at[keep], number[keep]
        used, number = np.unique(number, return_inverse=True)
        if len(at) < LEAST_SAVING * len(symbols):
            break
        pair = pairs[chosen[used]]
        a, b = (pair >> np.uint64(32)).astype(np.uint32), pair.astype(np.uint32)
        lengths = np.concatenate((np.ones(base, np.uint32), sizes))
        symbols = symbols.copy()
        symbols[at] = base + len(left) + number
        symbols = np.delete(symbols, at + 1)
        left, right, sizes = np.concatenate((left, a)), np.concatenate((right, b)), np.concatenate((sizes, lengths[a] + lengths[b]))
    return symbols, left, right, sizes


def pack_shard(ids: np.ndarray, lengths: np.ndarray, base: int) -> bytes:
    symbols, left, right, sizes = compress(ids, base, None if base < 1 << 16 else 1 << 16)
    kind = "<u2" if base + len(left) <= 1 << 16 else "<u4"
    head = MAGIC + struct.pack("<4Q", base, len(left), len(symbols), len(lengths))
    return b"".join([head, left.astype("<u4").tobytes(), right.astype("<u4").tobytes(), sizes.astype("<u4").tobytes(), lengths.astype("<u8").tobytes(), symbols.astype(kind).tobytes()])


class Shard:
    """A shard's parts, as views of its bytes."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard of this format")
        self.base, rules, symbols, documents = struct.unpack_from("<4Q", data, 4)
        at = 36
        self.left, self.right, self.sizes = (np.frombuffer(data, "<u4", rules, at + 4 * rules * i) for i in range(3))
        at += 12 * rules
        self.lengths = np.frombuffer(data, "<u8", documents, at).astype(np.int64)
        self.symbols = np.frombuffer(data, "<u2" if self.base + rules <= 1 << 16 else "<u4", symbols, at + 8 * documents)

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """All rules' expansions, each from the two before it, then the symbols' in a row."""
        symbols = symbols.astype(np.int64)
        while True:
            rules = symbols >= self.base
            if not rules.any():
                return symbols.astype(np.uint32)
            sizes = 1 + rules.astype(np.int64)
            heads = bounds(sizes)[:-1]
            out = np.empty(int(sizes.sum()), np.int64)
            out[heads] = symbols
            at = heads[rules]
            rule = symbols[rules] - self.base
            out[at] = self.left[rule]
            out[at + 1] = self.right[rule]
            symbols = out

    def ids(self, start: int = 0, length: int | None = None) -> np.ndarray:
        """The ids from ``start`` on; only the symbols that cover them are expanded."""
        if length is None and start == 0:
            return self._expanded(self.symbols)
        symbols = self.symbols.astype(np.int64)
        sizes = np.ones(len(symbols), np.int64)
        rules = symbols >= self.base
        sizes[rules] = self.sizes[symbols[rules] - self.base]
        edges = bounds(sizes)
        end = edges[-1] if length is None else min(start + length, edges[-1])
        if start >= end:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(edges, start, side="right") - 1, np.searchsorted(edges, end)
        return self._expanded(symbols[a:b])[start - edges[a] : end - edges[a]]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.lengths[:i].sum()), int(self.lengths[i]))


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Encodes all documents and writes them in ascending ``doc_id`` order as shards under ``path``.

    Reads ``doc_id`` and ``text``; a null text is empty and gives the end id alone.
    Rows with a null ``doc_id`` come first, rows with equal ids lie next to each other
    in the order of their texts' hashes. A shard closes with the document that
    brings it to ``shard_ids`` ids, or with the end of its sorted partition. An
    empty table gives no shard.
    """
    tokenizer = tokenizer or tokenizer_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        base = max(end_id + 1, encode.tokenizer.get_vocab_size())
        part, shard, start = None, 0, 0
        waiting: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def close() -> pa.RecordBatch:
            nonlocal shard, start
            ids = np.concatenate([w[0] for w in waiting])
            lengths = np.concatenate([w[1] for w in waiting])
            doc_ids = pa.concat_arrays([w[2] for w in waiting])
            row = [part, shard, start, len(ids), doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes(), doc_ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), pack_shard(ids, lengths, base)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            shard, start = shard + 1, start + len(ids)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in SHARDS.split(", ")])

        for batch in text_chunks(batches, "text"):
            part = batch.column("part")[0].as_py()
            ids, edges = encode.encode(batch.column("text"))
            ids, edges = np.insert(ids, edges[1:], end_id), edges + np.arange(len(edges))
            waiting.append((ids, np.diff(edges), batch.column("doc_id")))
            if sum(len(w[0]) for w in waiting) >= shard_ids:
                yield close()
        if waiting:
            yield close()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    docs = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(int(parts), F.asc_nulls_first("doc_id"), "tie").sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie", "text")
    docs.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(work, SHARDS).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document in the shards."""
    shards = spark.read.parquet(path)
    sums = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    order = sorted(sums)
    before = dict(zip(order, bounds(np.array([sums[p] for p in order], np.int64)).tolist(), strict=False))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["data"])
                edges = bounds(shard.lengths)
                doc_ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~np.frombuffer(row["known"], bool))
                ids = shard.ids().astype("<u4")
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(before[row["part"]] + row["start"] + edges[:-1]), pa.array(shard.lengths), binaries(ids, edges * 4)], ["doc_id", "start", "n_tokens", "ids"])

    return shards.mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary")


