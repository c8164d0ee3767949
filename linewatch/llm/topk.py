"""Exact top-k inner products by norm buckets.

Candidates are dealt into parts of like length. Every query meets the longest part
first, whose k-th best score is its threshold: divided by the query's length it is the
length that a useful vector must have. So a query goes to those other parts only whose longest
vector reaches it, together with queries that need about the same length. Within a
part, buckets of candidates are visited from the longest down; the threshold over the
query's and the bucket's greatest length is the cosine that a useful vector must reach.
Above 1 the bucket and all after it are skipped. A high cosine cuts by coordinates:
on the query's largest coordinates a vector's share has a tight upper bound, which rules most
vectors out without a product; a low one cuts by length only. What remains is
verified by whole products, for groups of queries that need about the same length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged

BUCKET = 512
QUERY_BLOCK = 2_048
PART_ROWS = 4_096
MOST_PARTS = 4_096  # beyond, parts and blocks grow instead of their number, which the driver holds
COORDINATES = 4
BY_COORDINATES = 0.6
ALIKE = 64  # queries whose products are taken together
SLACK = 1 + 1e-9  # of a bound computed with rounding

FOUND = "query_id long, vec_id long, score long"
STARTED = "id long, v binary, size double, least long, vec_ids array<long>, scores array<long>"


def whole_numbers(vector: str, scale: float) -> Column:
    """Components as ``floor(scale * x)``; null if any is null or not finite, or there is none."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    numbers = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return F.when(~bad & (F.size(vector) > 0), numbers)


NOTHING = np.iinfo(np.int64).min


class Best:
    """The k best of each query so far: scores, owners, and the least score that still counts."""

    def __init__(self, k: int, least: np.ndarray):
        self.k = k
        self.floor = least  # NOTHING where nothing is known
        self.score = np.full((len(least), k), NOTHING)
        self.owner = np.full((len(least), k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        return np.maximum(self.floor, self.score[:, -1])

    def add(self, rows: np.ndarray, products: np.ndarray, keep: np.ndarray, own: np.ndarray) -> None:
        """Products of queries ``rows`` with vectors ``own``, where ``keep`` holds; ties go to the smaller id."""
        hit = keep.any(1)
        rows, products, keep = rows[hit], products[hit], keep[hit]
        if not len(rows):
            return
        score = np.concatenate((self.score[rows], np.where(keep, products, NOTHING)), axis=1)
        owner = np.concatenate((self.owner[rows], np.broadcast_to(own, products.shape)), axis=1)
        first = np.lexsort((owner, ~score), axis=1)[:, : self.k]
        self.score[rows], self.owner[rows] = (np.take_along_axis(m, first, 1) for m in (score, owner))


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best of ``vectors`` for each query that reach ``least``: query number, vector id, score, and how many products were taken.

    Scores are exact: products are taken in double precision only where no sum can
    reach 2**53, else in whole numbers. A query's own id is left out.
    """
    q_len, v_len = (np.sqrt((m.astype(float) ** 2).sum(1)) for m in (queries, vectors))
    order = np.lexsort((ids, -v_len))
    vectors, ids, v_len = vectors[order], ids[order], v_len[order]
    exact = len(q_len) and len(v_len) and q_len.max() * v_len.max() < 2**52
    kind = np.float64 if exact else np.int64
    queries_k, vectors_k = queries.astype(kind), vectors.astype(kind)
    best = Best(k, np.full(len(queries), NOTHING) if least is None else least)
    focus = np.argsort(-np.abs(queries), axis=1, kind="stable")[:, :COORDINATES]
    taken = 0
    for a in range(0, len(ids), BUCKET):
        size, own = v_len[a : a + BUCKET], ids[a : a + BUCKET]
        need = _needed(best.least(), q_len)  # the length that a vector must have
        live = np.flatnonzero(need <= size[0] * SLACK)
        if not len(live):
            break  # later buckets are shorter, and thresholds only rise
        live = live[np.argsort(need[live], kind="stable")]
        for i in range(0, len(live), ALIKE):
            rows = live[i : i + ALIKE]
            wide = len(size) - int(np.searchsorted(size[::-1], need[rows[0]] / SLACK))
            block = vectors_k[a : a + wide]
            keep = query_ids[rows][:, None] != own[:wide]
            with np.errstate(divide="ignore", invalid="ignore"):
                sharp = need[rows] / size[0] >= BY_COORDINATES
            if sharp.any():
                keep[sharp] &= _within(queries[rows[sharp]], focus[rows[sharp]], block, q_len[rows[sharp]], size[:wide], best.least()[rows[sharp]])
            some = keep.any(0)
            if keep.sum() * 4 < len(rows) * some.sum():  # few are left: products of the pairs alone
                q, v = np.nonzero(keep)
                products = np.zeros(keep.shape, np.int64)
                products[q, v] = (queries_k[rows[q]] * block[v]).sum(1).astype(np.int64)
                taken += len(q)
            else:
                products = np.zeros(keep.shape, np.int64)
                products[:, some] = (queries_k[rows] @ block[some].T).astype(np.int64)
                taken += len(rows) * int(some.sum())
            best.add(rows, products, keep & (products >= best.least()[rows][:, None]), own[:wide])
    found = best.score > NOTHING
    return np.nonzero(found)[0], best.owner[found], best.score[found], taken


def _needed(least: np.ndarray, q_len: np.ndarray) -> np.ndarray:
    """The least length of a vector whose product can reach ``least``; none is needed for a product of 0 or below."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(least <= 0, 0.0, least / q_len)


def _within(queries: np.ndarray, focus: np.ndarray, block: np.ndarray, q_len: np.ndarray, v_len: np.ndarray, least: np.ndarray) -> np.ndarray:
    """False where the focus coordinates and the rest's lengths prove the product below ``least``."""
    keep = np.zeros((len(queries), len(block)), bool)
    squares = v_len**2
    for i, f in enumerate(focus):
        on_q, on_v = queries[i, f].astype(float), block[:, f].astype(float)
        rest_q = math.sqrt(max(0.0, q_len[i] ** 2 - (on_q**2).sum()))
        rest_v = np.sqrt(np.maximum(0.0, squares - (on_v**2).sum(1)))
        bound = on_v @ on_q + rest_q * rest_v
        keep[i] = bound + np.abs(bound) * (SLACK - 1) + 1e-6 >= least[i]
    return keep


def _rank_key(value: Column) -> Column:
    """A whole number that orders rows by ``value`` and deals out rows with the same one."""
    clipped = F.least(F.greatest(value, F.lit(0.0)), F.lit(2.0**22))
    return F.floor(clipped * 2**20).cast("long") * (1 << 20) + F.xxhash64("id").bitwiseAND(F.lit((1 << 20) - 1))


def _cuts(df: DataFrame, key: str, parts: int) -> np.ndarray:
    """Quantiles of ``key`` between ``parts`` parts."""
    inner = [(i + 1) / parts for i in range(parts - 1)]
    found = df.agg(F.percentile_approx(key, inner, max(10_000, 20 * parts))).first()[0] if inner else None
    return np.asarray(found or [], np.int64)


def _place(cuts: np.ndarray, key: str) -> Column:
    """The number of the cuts up to ``key``."""

    @F.arrow_udf("int")
    def place(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, values.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    return place(F.col(key))


def _packed(biggest: float, width: int) -> tuple[Column, np.dtype]:
    """Vectors as bytes of the narrowest whole numbers that hold them all, padded with zeros."""
    kind = next((np.dtype(t) for t in (np.int16, np.int32) if biggest <= np.iinfo(t).max), np.dtype(np.int64))

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
        out = np.zeros((len(vectors), width), kind)
        out[np.arange(width) < sizes[:, None]] = flat
        return pa.array([row.tobytes() for row in out], pa.binary())

    return pack(F.col("v")), kind


def _matrix(column: pa.ChunkedArray, kind: np.dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.int64)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, vector: str = "embedding", vector_id: str = "vec_id", products: Accumulator | None = None
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` best inner products, exactly.

    Queries are the rows for which ``is_query`` holds, candidates all rows with another
    id. A block of about ``QUERY_BLOCK`` queries meets a part of about ``PART_ROWS`` candidates in a task: all blocks
    the longest part, the others only parts that can still matter to them. The results of each task, at most ``k`` a query,
    are merged by a window that keeps ``k`` rows a query and task. Rows with a
    null id, or a vector that is null, empty or holds a null or non-finite
    component take no part; a shorter vector counts as padded with zeros; of
    several query rows with one id the smallest vector asks; repeated candidates
    are candidates each. Fewer than ``k`` candidates give as many rows. ``products`` adds up how many products were taken.
    """
    numbers = vectors.select(F.col(vector_id).cast("long").alias("id"), whole_numbers(vector, scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    numbers = numbers.where("id is not null and v is not null")
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    numbers = numbers.withColumn("size", size).withColumn("key", _rank_key(F.col("size")))
    most = F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))
    count, asking, width, biggest = numbers.agg(F.count("*"), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(1)), F.coalesce(most, F.lit(0.0))).first()
    parts, blocks = (min(MOST_PARTS, max(1, math.ceil(n / rows))) for n, rows in ((count, PART_ROWS), (asking, QUERY_BLOCK)))
    packed, kind = _packed(biggest, width)
    # part 0 holds the longest vectors
    part = F.lit(parts - 1) - _place(_cuts(numbers, "key", parts), "key")
    candidates = numbers.select("id", packed.alias("v"), "size", part.cast("int").alias("part"))
    queries = numbers.where("asks").groupBy("id").agg(F.min("v").alias("v")).select("id", packed.alias("v"), size.alias("size"))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def search(q: pa.Table, c: pa.Table, least: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = search_block(_matrix(q["v"], kind, width), q["id"].to_numpy(), _matrix(c["v"], kind, width), c["id"].to_numpy(), k, least)
        if products is not None:
            products.add(found[3])
        return found[:3]

    def start(q: pa.Table, c: pa.Table) -> pa.Table:
        row, who, score = search(q, c, None)
        edges = np.searchsorted(row, np.arange(len(q) + 1))
        full = np.diff(edges) == k
        least = np.zeros(len(q), np.int64)
        least[full] = score[edges[1:][full] - 1]
        lists = [pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(x)) for x in (who, score)]
        return pa.table([q["id"].combine_chunks(), q["v"].combine_chunks(), q["size"].combine_chunks(), pa.array(least, mask=~full), *lists], names=[c.split()[0] for c in STARTED.split(", ")])

    longest = candidates.where("part = 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("block", "id", "v")
    started = staged(queries.groupBy("block").cogroup(longest.groupBy("block")).applyInArrow(start, STARTED), compression="zstd")
    found = started.select(F.col("id").alias("query_id"), F.explode(F.arrays_zip("vec_ids", "scores")).alias("x")).select("query_id", F.col("x.vec_ids").alias("vec_id"), F.col("x.scores").alias("score"))
    if parts > 1:
        found = found.unionByName(_others(started, candidates, parts, blocks, search))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _others(started: DataFrame, candidates: DataFrame, parts: int, blocks: int, search) -> DataFrame:
    """What the parts beyond the longest add: queries that need about the same length go together, to the parts that have it."""
    need = F.when(F.col("least") <= 0, 0.0).otherwise(F.coalesce(F.col("least") / F.col("size"), F.lit(0.0)))
    asks = started.select("id", "v", "least", need.alias("need")).withColumn("key", _rank_key(F.col("need")))
    asks = asks.withColumn("block", _place(_cuts(asks, "key", blocks), "key")).drop("key")
    # at most MOST_PARTS rows each; both fall, or rise, with their number
    reach = {r.part: r.size for r in candidates.groupBy("part").agg(F.max("size").alias("size")).collect()}
    needed = {r.block: r.need for r in asks.groupBy("block").agg(F.min("need").alias("need")).collect()}
    reached = np.maximum.accumulate([reach.get(p, 0.0) for p in range(parts - 1, 0, -1)])[::-1] * SLACK  # of part 1, 2 ...
    lowest = np.minimum.accumulate([needed.get(b, math.inf) for b in range(blocks - 1, -1, -1)])[::-1]
    # a query's parts are the first of them, a part's blocks the first of those
    falling = np.ascontiguousarray(-reached)
    of_part = [0, *np.searchsorted(lowest, reached, side="right").tolist()]

    @F.arrow_udf("int")
    def last_part(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(falling, -values.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    def spread(df: DataFrame, name: str, first: int, last: Column) -> DataFrame:
        return df.withColumn("last", last).where(F.col("last") >= first).withColumn(name, F.explode(F.sequence(F.lit(first), F.col("last")))).drop("last")

    q = spread(asks, "part", 1, last_part(F.col("need"))).drop("need")
    c = spread(candidates.where("part > 0"), "block", 0, F.get(F.array(*map(F.lit, of_part)), F.col("part")) - 1).select("part", "block", "id", "v")

    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        least = pa.compute.fill_null(q["least"], int(NOTHING)).to_numpy()
        row, who, score = search(q, c, least) if len(q) and len(c) else [np.zeros(0, np.int64)] * 3
        return pa.table([q["id"].to_numpy()[row] if len(row) else row, who, score], names=[c.split()[0] for c in FOUND.split(", ")])

    return q.groupBy("part", "block").cogroup(c.groupBy("part", "block")).applyInArrow(cell, FOUND)
