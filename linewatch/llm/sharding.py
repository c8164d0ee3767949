"""Sharding by sampled splitters.

Records lie in the order of a key made of their text's hash and their id, so equal
texts are neighbours. A size-weighted sample of keys gives quantile boundaries for
many more ranges than shards; ranges that turn out overfull get boundaries of their
own from a denser sample of just their records. Neighbouring ranges then fill the
shards, and records are moved once, to the task of their range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounds, free_name, row_hash

RANGES_PER_SHARD = 64
RANGE_BYTES = 256_000_000
SAMPLES_PER_RANGE = 16
OVERFULL = 2.0


def _key(text: str, record_id: str) -> Column:
    """39 bits of the text's hash, then 24 bits of the id's."""
    high = F.shiftright(F.xxhash64(text), 24).bitwiseAND(F.lit((1 << 39) - 1))
    return F.shiftleft(high, 24).bitwiseOR(F.xxhash64(record_id, text).bitwiseAND(F.lit((1 << 24) - 1)))


def _sample(keys: DataFrame, weight: float, seed: int) -> list[int]:
    """Keys drawn with a chance of ``size * weight``, at least once where that is 1 or more."""
    chance = F.pmod(F.xxhash64("key", "tie", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = F.floor(F.col("size") * F.lit(weight) + chance)
    drawn = keys.withColumn("times", times).where("times > 0").groupBy("key").agg(F.sum("times").alias("times"))
    rows = drawn.orderBy("key").collect()
    return [k for k, n in rows for _ in range(int(min(n, SAMPLES_PER_RANGE)))]


def _range_of(cuts: np.ndarray, name: str = "key") -> Column:
    @F.pandas_udf("int")
    def number(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="right").astype(np.int32))

    return number(name)


def _totals(keys: DataFrame, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of every range."""
    size, rows = np.zeros(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, np.int64)
    for r in keys.groupBy(_range_of(cuts).alias("range")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        size[r["range"]], rows[r["range"]] = r["size"], r["n"]
    return size, rows


def splitters(keys: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Range boundaries, and the bytes and rows of the ranges between them.

    ``keys`` has key, tie and size. The driver holds at most ``SAMPLES_PER_RANGE``
    keys a range, so its share grows with the bytes, by 16 numbers for each ``RANGE_BYTES``; there are ``RANGES_PER_SHARD`` ranges a shard, or one for each
    ``RANGE_BYTES``. A range of one key (repeated rows) can't be divided further.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranges = max(shards * RANGES_PER_SHARD, math.ceil(total / RANGE_BYTES))
    if not total:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    drawn = np.array(_sample(keys, ranges * SAMPLES_PER_RANGE / total, 1), np.int64)
    cuts = np.unique(drawn[(np.arange(1, ranges) * len(drawn)) // ranges]) if len(drawn) else np.zeros(0, np.int64)
    size, rows = _totals(keys, cuts)
    for again in count():  # until no range can be divided
        overfull = np.flatnonzero((size > OVERFULL * total / ranges) & (rows > 1))
        if not len(overfull):
            break
        inside = keys.withColumn("range", _range_of(cuts)).where(F.col("range").isin(overfull.tolist()))
        more = np.array(_sample(inside, ranges * SAMPLES_PER_RANGE * 4 / total, 2 + again), np.int64)
        owner = np.searchsorted(cuts, more, side="right")
        new = []
        for r in overfull.tolist():
            own = more[owner == r]
            pieces = min(len(own), math.ceil(size[r] * ranges / total))
            new += [own[(i * len(own)) // pieces] for i in range(1, pieces)]
        wider = np.unique(np.concatenate((cuts, np.array(new, np.int64))))
        if len(wider) == len(cuts):
            break
        cuts = wider
        size, rows = _totals(keys, cuts)
    return cuts, size, rows


def shard(records: DataFrame, shards: int = 16, text: str = "text", record_id: str = "doc_id") -> DataFrame:
    """All columns of ``records`` and ``size``, ``shard`` and ``slot``; rows move to their shard's range.

    Sizes are the text's UTF-8 bytes plus 1 (null: 1). Shards are runs of ranges of
    near equal bytes: a shard differs from the mean by about one range, a 64th of
    a shard, or by its largest record. ``slot`` numbers a shard's records without
    gaps from 0. Nulls sort by their hash like any value; repeated rows follow each
    other; fewer rows than shards leave shards empty; an empty table gives no row.
    A column called size, shard or slot keeps its name and is replaced.
    """
    key, tie, size, rng = (free_name(records, n) for n in ("key", "tie", "size", "range"))
    table = records.withColumns({size: F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1, key: _key(text, record_id), tie: F.xxhash64(record_id)})
    cuts, total, rows = splitters(table.select(F.col(key).alias("key"), F.col(tie).alias("tie"), F.col(size).alias("size")), shards)
    edges = bounds(total)
    middle = (edges[:-1] + edges[1:]) / 2
    owner = np.minimum((middle * shards / max(1, edges[-1])).astype(np.int64), shards - 1)
    ahead = bounds(rows)[:-1]
    first_row = np.array([ahead[owner >= s][0] if (owner >= s).any() else 0 for s in range(shards)])
    slot_base = ahead - first_row[owner]

    rest = records.drop("size", "shard", "slot")
    kept = rest.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = -1, 0
        for batch in batches:
            own = batch.column(rng).to_numpy()
            where = np.arange(len(own))
            heads = np.diff(own, prepend=last) != 0
            start = np.maximum.accumulate(np.where(heads, where, -1))
            rank = np.where(start < 0, where + seen, where - start)
            if len(own):
                last, seen = own[-1], int(rank[-1]) + 1
            values = {"size": batch.column(size), "shard": pa.array(owner[own].astype(np.int32)), "slot": pa.array(slot_base[own] + rank)}
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *values.values()], [*kept, *values])

    parts = max(len(total), int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = min(parts, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4)
    moved = table.withColumn(rng, _range_of(cuts, key)).repartitionById(parts, F.col(rng)).sortWithinPartitions(rng, key, tie, record_id, row_hash(records))
    out = rest.schema.add("size", "long").add("shard", "integer").add("slot", "long")
    return moved.mapInArrow(number, out)


def write(records: DataFrame, path: str, shards: int = 16, **columns: str) -> None:
    """One folder ``shard=N`` a shard; rows in a folder's files keep their ``slot``."""
    shard(records, shards, **columns).write.partitionBy("shard").parquet(path)
