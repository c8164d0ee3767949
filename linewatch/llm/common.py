"""What the operators share: chunks of Arrow batches, text buffers, ragged arrays, free names."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1_000_000


def free_name(df: DataFrame, wish: str) -> str:
    """``wish`` with a random ending, so that no column of ``df`` can have it."""
    return f"__{wish}_{uuid.uuid4().hex[:12]}"


def id_text_crc(column: str) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns; those that Spark hashes only in other forms, such as maps, as JSON."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        plain = not any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
        columns.append(column if plain else F.to_json(F.struct(column)))
    return F.xxhash64(*columns)


MOST_HOT = 4_096
LEAST_HOT = 1_000


def join_unique(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """``left`` and the columns of ``right``, which has one row a ``key``, joined without a hot key.

    ``rows`` is the number of rows of ``left``. Keys with more than a ``MOST_HOT``-th of them, so
    fewer than ``MOST_HOT``, are broadcast with their counts; their rows are dealt over
    several salts by their hash, and their row of ``right`` is copied to each.
    """
    limit = max(LEAST_HOT, rows // MOST_HOT)
    salts, salt, hot_key = free_name(left, "salts"), free_name(left, "salt"), free_name(left, "hot")
    hot = left.groupBy(F.col(key).alias(hot_key)).count().where(F.col("count") > limit)
    hot = F.broadcast(hot.select(hot_key, F.ceil(F.col("count") / limit).alias(salts)))

    def salted(df: DataFrame, number: Column) -> DataFrame:
        known = df.join(hot, F.col(key).eqNullSafe(F.col(hot_key)), "left")
        return known.withColumn(salt, F.when(F.col(salts).isNull(), F.array(F.lit(0).cast("long"))).otherwise(number)).drop(salts, hot_key)

    one = F.array(F.pmod(row_hash(left), F.col(salts)))
    every = F.sequence(F.lit(0).cast("long"), F.col(salts) - 1)
    a = salted(left, one).withColumn(salt, F.get(salt, F.lit(0)))
    b = salted(right, every).withColumn(salt, F.explode(salt))
    return a.join(b, [key, salt]).drop(salt)


def text_chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about ``limit`` bytes; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = (np.cumsum(sizes) - 1) // limit
        cuts = np.flatnonzero(np.diff(run)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes in a row and the n + 1 offsets of the texts; null is empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i]``, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def bounds(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def per_run(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``edges``; empty runs give 0."""
    if values.dtype.kind == "f":  # a running total would carry its rounding into every run
        out = np.zeros(len(edges) - 1)
        filled = np.flatnonzero(np.diff(edges))
        if len(filled):
            out[filled] = np.add.reduceat(values, edges[:-1][filled])
        return out
    total = np.concatenate((np.zeros(1, values.dtype if values.dtype != bool else np.int64), np.cumsum(values)))
    return total[edges[1:]] - total[edges[:-1]]


def binaries(data: bytes | np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary value per run of bytes between neighbouring ``edges``."""
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(np.ascontiguousarray(edges, np.int64)), pa.py_buffer(data)]).cast(pa.binary())
