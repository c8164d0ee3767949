"""Packing along a space-filling curve.

Each document becomes a hashed, normalised vector of its ids, projected to a few
dimensions. A grid of quantiles turns the projection into a cell, and the cell's
place on the Hilbert curve into the document's sort key. Documents lie one after
the other along the curve, so neighbours in a sequence are alike, and are cut
every ``length`` ids: only the very last sequence is short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import binaries, bounds, ragged, text_chunks, utf8
from .tokens import encoder, tokenizer_path

DIMENSIONS = 4
GRID_BITS = 8
HASHED = 512
PART_IDS = 4_000_000
MOST_PARTS = 16_384
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def projection(ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One row per document: its hashed counts, damped and normalised, in few dimensions."""
    n = len(edges) - 1
    random = np.random.Generator(np.random.PCG64(7))
    table = random.integers(0, HASHED, 1 << 17)
    plane = random.standard_normal((HASHED, DIMENSIONS))
    owner = np.repeat(np.arange(n) * HASHED, np.diff(edges))
    counts = np.sqrt(np.bincount(owner + table[ids & 0x1FFFF], minlength=n * HASHED).reshape(n, HASHED))
    norms = np.sqrt((counts * counts).sum(1, keepdims=True))
    return (counts / np.maximum(norms, 1e-12)) @ plane


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of whole-number ``cells`` (rows by dimensions), ``bits`` a dimension.

    The axes are rotated and reflected from the highest bit down, so that each
    sub-cube starts where the one before it ends; the Gray code of the interleaved
    bits is then the place.
    """
    x = [c.astype(np.int64) for c in cells.T]
    d = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[d - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            place = (place << 1) | (((x[i] ^ turn) >> level) & 1)
    return place


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, n, ids (16-bit where they fit, else 32-bit) and the projection x0, x1, ..."""
    names = [f"x{i}" for i in range(DIMENSIONS)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        kind = id_type(max(end_id, encode.tokenizer.get_vocab_size()))
        for batch in text_chunks(batches, "text"):
            ids, edges = encode.encode(batch.column("text"))
            ids, edges = np.insert(ids, edges[1:], end_id), edges + np.arange(len(edges))
            x = projection(ids, edges)
            blobs = binaries(ids.astype(kind), edges * np.dtype(kind).itemsize)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(edges)), blobs, *(pa.array(c) for c in x.T)], ["doc_id", "n", "ids", *names])

    return docs.mapInArrow(work, "doc_id long, n long, ids binary, " + ", ".join(f"{x} double" for x in names))


def id_type(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def pack(docs: DataFrame, length: int = 2048, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Pieces (:data:`PIECES`) of all documents, which fill sequences of ``length`` ids without gaps.

    Reads the columns ``doc_id`` and ``text``; others may have any name. A null text
    is empty and gives one id, the end. Rows with a null or repeated ``doc_id`` are
    documents of their own. An empty table gives no piece. ``ids`` holds each
    piece's ids as little-endian unsigned 32-bit integers; ``start`` counts its document's
    ids before it, ``sequence_id`` and ``offset`` say where it lies. Documents of one place on the curve follow each other
    by a hash, then by id and content; a text of any length is encoded whole and cut at sequences.

    Ids are written once to the shared folder. The driver sees grid quantiles, at
    most ``MOST_PARTS`` sort boundaries and as many sums; beyond ``MOST_PARTS * PART_IDS`` ids (65 thousand million) parts
    grow instead of their number. A task streams its part, so that costs time and sort spills, not memory.
    """
    tokenizer = tokenizer or tokenizer_path()
    kind = id_type(max(end_id, encoder(tokenizer).tokenizer.get_vocab_size()))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = staged(encoded(docs, tokenizer, end_id), compression="zstd")
    axes = [f"x{i}" for i in range(DIMENSIONS)]
    steps = [(i + 1) / (1 << GRID_BITS) for i in range((1 << GRID_BITS) - 1)]
    known = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), *(F.percentile_approx(a, steps, 10_000).alias(a) for a in axes)).first()
    grid = [np.asarray(known[a] or [], float) for a in axes]

    def keys(rest: pd.Series, x: tuple[pd.Series, ...]) -> np.ndarray:
        cells = np.stack([np.searchsorted(g, v.to_numpy(), side="right") for g, v in zip(grid, x, strict=True)], axis=1)
        return hilbert(cells, GRID_BITS) << 31 | rest.to_numpy()

    @F.pandas_udf("long")
    def key_of(rest: pd.Series, *x: pd.Series) -> pd.Series:
        return pd.Series(keys(rest, x))

    rest = F.xxhash64("doc_id", "n").bitwiseAND(F.lit((1 << 31) - 1))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MOST_PARTS, max(tasks, math.ceil(known["total"] / PART_IDS)))
    inner = [(i + 1) / parts for i in range(parts - 1)]
    cuts = np.asarray((table.agg(F.percentile_approx(key_of(rest, *axes), inner, max(10_000, 20 * parts))).first()[0] if inner else None) or [], np.int64)

    @F.pandas_udf("key long, part int")  # both at once: a chain of two would keep two workers a task
    def located(rest: pd.Series, *x: pd.Series) -> pd.DataFrame:
        key = keys(rest, x)
        return pd.DataFrame({"key": key, "part": np.searchsorted(cuts, key, side="right").astype(np.int32)})

    table = table.withColumn("at", located(rest, *axes)).select("doc_id", "n", "ids", "at.key", "at.part")
    sums = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before = bounds(np.array([sums.get(i, 0) for i in range(parts)], np.int64))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = -1, 0
        for batch in text_chunks(batches, "ids"):
            own, n = (batch.column(c).to_numpy() for c in ("part", "n"))
            ahead = bounds(n)
            heads = np.flatnonzero(np.diff(own, prepend=part))
            # each row's place: its part's first place, or where the last batch ended, and the rows between
            base = np.full(len(own), at, np.int64)
            for h in heads.tolist():
                base[h:] = before[own[h]] - ahead[h]
            place = base + ahead[:-1]
            part, at = own[-1], place[-1] + n[-1]
            first = place // length
            count = (place + n - 1) // length - first + 1
            row = np.repeat(np.arange(len(n)), count)
            sequence = ragged(first, count)
            begin = np.maximum(place[row], sequence * length)
            end = np.minimum(place[row] + n[row], (sequence + 1) * length)
            data, _ = utf8(batch.column("ids"))
            ids = np.frombuffer(data.tobytes(), kind).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), *(pa.array(a) for a in (begin - place[row], end - begin, n[row], sequence, begin - sequence * length)), binaries(ids, bounds(end - begin) * 4)],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    ordered = table.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "doc_id", F.xxhash64("ids"), "ids")
    return ordered.select("doc_id", "n", "ids", "part").mapInArrow(cut, PIECES)
