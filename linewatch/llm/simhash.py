"""SimHash near duplicates with a Gray-ordered hierarchical index.

Fingerprints that differ in at most ``distance`` bits agree on all but ``distance`` of
some blocks of bits, so each distinct fingerprint goes to the bucket of each choice
of so many blocks. There are the more blocks, and the more bits tell a bucket, the more fingerprints
there are. Within a bucket fingerprints are sorted by Gray rank, runs of
neighbours become leaves and runs of nodes become upper nodes; a node keeps the bits
that all below it share as a mask and a pattern. Two nodes are compared on the
masked bits their parents did not share yet, differences add up on the way down,
and a pair of groups goes as a whole once they exceed the distance.

Buckets emit a spanning forest of their links, so what leaves a bucket never
exceeds its rows. The links are then contracted to components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import bounds, free_name, join_unique, ragged, row_hash, text_chunks, utf8

LEAF = 16
FAN = 8
BUCKET_ROWS = 20_000
BUCKET_MEAN = 2_000
BATCH_ROWS = 200_000
PAIRS = 20_000
VOTES = 1 << 17


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64, seed 42, of the space-joined shingles of a text in lower case; repeats included."""
    words = text.split()  # at 0x20 and 0x09-0x0D
    if not words:
        return []
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(line, 42)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends[: len(words) - width + 1] - [len(w) + 1 for w in words[: len(words) - width + 1]]).tolist()
    return [digest(line[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]


def fingerprint(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits set in over half of them."""
    votes = np.zeros((len(edges) - 1, 64), np.int64)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    for a in range(0, len(hashes), VOTES):
        own = owner[a : a + VOTES]
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        bits = np.unpackbits(hashes[a : a + VOTES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    majority = (2 * votes > np.diff(edges)[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, width: int = 4, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a long of the same bits.

    A text of fewer words than ``width`` is one shingle; one without words, or
    null, has fingerprint zero.
    """
    docs = docs.select(*keep, F.col(text).cast("string").alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "__text"):
            data, offsets = utf8(batch.column("__text"))
            low = data.tobytes().lower()  # of bytes: A-Z only
            at = offsets.tolist()
            found = [shingle_hashes(low[a:b], width) for a, b in zip(at, at[1:], strict=False)]
            flat = np.fromiter((h for f in found for h in f), np.uint64, sum(map(len, found)))
            fps = fingerprint(flat, bounds(np.array([len(f) for f in found], np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(fps.view(np.int64))], [*keep, "fp"])

    return docs.mapInArrow(work, docs.drop("__text").schema.add("fp", "long"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each word in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """A forest over groups of fingerprints, and the self-join that descends it.

    ``fps`` must come sorted by group and Gray rank. ``root`` holds each row's smallest
    row number among those it is linked to so far.
    """

    def __init__(self, fps: np.ndarray, group: np.ndarray, distance: int):
        self.fps, self.distance = fps, distance
        self.root = np.arange(len(fps))
        heads = np.flatnonzero(np.diff(group, prepend=-1))
        sizes = np.diff(np.append(heads, len(fps)))
        leaves = -(-sizes // LEAF)
        self.starts = np.repeat(heads, leaves) + LEAF * ragged(np.zeros(len(heads), np.int64), leaves)
        self.ends = np.append(self.starts[1:], len(fps))
        both, any_ = np.bitwise_and.reduceat(fps, self.starts), np.bitwise_or.reduceat(fps, self.starts)
        tree = np.repeat(np.arange(len(heads)), leaves)
        self.tree = tree
        self.levels = [(~(both ^ any_), both, None, None)]
        while len(tree) > len(heads):
            heads_here = np.flatnonzero(np.diff(tree, prepend=-1))
            counts = np.diff(np.append(heads_here, len(tree)))
            nodes = -(-counts // FAN)
            first = np.repeat(heads_here, nodes) + FAN * ragged(np.zeros(len(heads_here), np.int64), nodes)
            last = np.append(first[1:], len(tree))
            both, any_ = np.bitwise_and.reduceat(both, first), np.bitwise_or.reduceat(any_, first)
            self.levels.append((~(both ^ any_), both, first, last))
            tree = np.repeat(np.arange(len(heads)), nodes)

    def unite(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up

    def _compare(self, a: np.ndarray, b: np.ndarray) -> None:
        """Verifies leaf against leaf, but for leaves that already are one component."""
        for at in range(0, len(a), PAIRS):
            x, y = a[at : at + PAIRS], b[at : at + PAIRS]
            low, high = np.minimum.reduceat(self.root, self.starts), np.maximum.reduceat(self.root, self.starts)
            apart = (low[x] != high[x]) | (low[y] != high[y]) | (low[x] != low[y])
            x, y = x[apart], y[apart]
            n, m = self.ends[x] - self.starts[x], self.ends[y] - self.starts[y]
            pair = np.repeat(np.arange(len(x)), n * m)
            inner = ragged(np.zeros(len(x), np.int64), n * m)
            i, j = self.starts[x][pair] + inner // m[pair], self.starts[y][pair] + inner % m[pair]
            near = (i < j) & (np.bitwise_count(self.fps[i] ^ self.fps[j]) <= self.distance)
            self.unite(i[near], j[near])

    def _descend(self, level: int, a: np.ndarray, b: np.ndarray, shared: np.ndarray, apart: np.ndarray) -> None:
        if level == 0:
            self._compare(a, b)
            return
        _, _, first, last = self.levels[level]
        mask, pattern, _, _ = self.levels[level - 1]
        for at in range(0, len(a), PAIRS):
            x, y = a[at : at + PAIRS], b[at : at + PAIRS]
            n, m = last[x] - first[x], last[y] - first[y]
            pair = np.repeat(np.arange(len(x)), n * m)
            inner = ragged(np.zeros(len(x), np.int64), n * m)
            i, j = first[x][pair] + inner // m[pair], first[y][pair] + inner % m[pair]
            known = shared[at : at + PAIRS][pair]
            now = mask[i] & mask[j]
            more = np.bitwise_count((pattern[i] ^ pattern[j]) & now & ~known)
            total = apart[at : at + PAIRS][pair] + more
            alive = (total <= self.distance) & (i <= j)
            self._descend(level - 1, i[alive], j[alive], now[alive], total[alive])

    def join(self) -> np.ndarray:
        leaves = np.arange(len(self.starts))
        self._compare(leaves, leaves)
        beside = leaves[:-1][self.tree[:-1] == self.tree[1:]]
        self._compare(beside, beside + 1)
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        self._descend(top, roots, roots, self.levels[top][0], np.zeros(len(roots), np.int64))
        return self.root


def _bucket_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """(fp, to) of a spanning forest of each bucket; batches come sorted by bucket."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        fps = rows["fp"].to_numpy().view(np.uint64)
        names = np.stack([rows[c].to_numpy() for c in ("key", "a", "b")])
        group = np.cumsum(np.append(True, (names[:, 1:] != names[:, :-1]).any(0)))
        order = np.lexsort((gray_rank(fps), group))
        fps = fps[order]
        root = GrayIndex(fps, group[order], distance).join()
        child = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fps[child].view(np.int64)), pa.array(fps[root[child]].view(np.int64))], ["fp", "to"])

    waiting = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        waiting = pa.concat_tables([waiting, rows]) if waiting is not None else rows
        if len(waiting) >= BATCH_ROWS:
            names = np.stack([waiting[c].to_numpy() for c in ("key", "a", "b")])
            changes = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(0))
            if len(changes):
                yield solve(waiting.slice(0, changes[-1] + 1))
                waiting = waiting.slice(changes[-1] + 1)
    if waiting is not None and len(waiting):
        yield solve(waiting)


def block_count(fingerprints: int, distance: int) -> int:
    """The fewest blocks with which a bucket holds ``BUCKET_MEAN`` evenly spread fingerprints or fewer."""
    for blocks in range(distance + 1, 16):
        bits = sum(sorted(_widths(blocks))[: blocks - distance])
        if fingerprints <= BUCKET_MEAN << bits:
            return blocks
    return 16


def _widths(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [b - a for a, b in zip(edges, edges[1:], strict=False)]


def bucket_keys(fp: str, blocks: int, distance: int) -> Column:
    """The buckets of a fingerprint: the bits of each choice of ``blocks - distance`` blocks, and the number of the choice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        bits = F.lit(0).cast("long")
        for i in chosen:
            width = edges[i + 1] - edges[i]
            bits = F.shiftleft(bits, width).bitwiseOR(F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(F.struct(F.lit(number).alias("choice"), bits.alias("bits")))
    return F.array(*keys)


def links(fps: DataFrame, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """(fp, to): enough pairs of distinct fingerprints within ``distance`` bits to connect all that are linked.

    A bucket of more than ``BUCKET_ROWS`` rows, which only unevenly spread fingerprints fill, is dealt into runs, and each pair of runs
    is a group of its own, so that no group outgrows a task and no pair is missed.
    """
    blocks = blocks or block_count(fps.count(), distance)
    # one number a bucket; two that share it by chance are a larger group, in which each pair is verified all the same
    rows = fps.select("fp", F.explode(bucket_keys("fp", blocks, distance)).alias("bucket"))
    rows = rows.select("fp", F.xxhash64("bucket.choice", "bucket.bits").alias("key"))
    large = rows.groupBy("key").count().where(F.col("count") > BUCKET_ROWS).select("key", F.ceil(F.col("count") / BUCKET_ROWS).alias("runs"))
    rows = rows.join(large, "key", "left").withColumn("runs", F.coalesce("runs", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("runs"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)))
    rows = rows.select("fp", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    rows = rows.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return rows.mapInArrow(lambda batches: _bucket_links(batches, distance), "fp long, to long").distinct()


def contract(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (fp, to): the smallest node it is connected to.

    Large stars hang each node's larger neighbours on its smallest neighbour, small
    stars the smaller ones, until nothing changes; each round is written to the
    shared folder.
    """
    edges = staged(edges.select(F.greatest("fp", "to").alias("u"), F.least("fp", "to").alias("v")).where("u <> v").distinct())
    last = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first()
        if state == last:
            break
        last = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_unique(both, least, "u", 2 * state[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_unique(large, least, "u", 2 * state[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least).distinct()
        edges = staged(small)
    return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(rows: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root, component_id): for every distinct fingerprint of ``rows`` (doc_id, fp) its component.

    ``root`` names the component, ``component_id`` is the smallest doc_id in it.
    """
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    roots = contract(links(distinct, distance))
    rooted = staged(distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return join_unique(rooted, least, "root", rooted.count()).select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Documents whose fingerprints differ in at most ``distance`` bits are linked, equal ones
    among them; a text of any length is hashed whole. A component's id is its smallest ``doc_id``. Null and wordless texts have
    fingerprint zero and are linked like any other. Rows with a null id belong to
    a component but never name it; one made only of them has a null id. Repeated
    rows stay. An empty table gives no row. Other columns may have any name.
    """
    rows = staged(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), width))
    found = join_unique(rows, classes(rows, distance), "fp", rows.count())
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each component left, all columns as they are.

    The row of the smallest ``doc_id`` stays, of several with it the one of the smallest
    row hash, of rows equal in every column one; rows with a null id stay only
    where their component has no other. Rows are known by id and row hash, so that
    documents of different ids never stand for each other.
    """
    mark = free_name(docs, "row")
    own_id = free_name(docs, "id")
    marked = docs.withColumns({mark: row_hash(docs), own_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(0))})
    rows = staged(fingerprints(marked.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(mark).alias("mark")), width, keep=("doc_id", "mark")))
    # the first row of each fingerprint meets its class, so copies of one text never do
    firsts = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")).alias("first"))
    named = firsts.join(classes(rows, distance).select("fp", "root"), "fp")
    first = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.mark").alias(mark), F.coalesce("first.doc_id", F.lit(0)).alias(own_id))
    return marked.join(first, [mark, own_id], "left_semi").dropDuplicates([mark, own_id]).drop(mark, own_id)
