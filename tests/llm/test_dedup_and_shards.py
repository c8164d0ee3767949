"""SimHash, the Gray index, sharding and top-k against brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import xxhash
from compare import connect, difference
from pyspark.sql import functions as F

from linewatch.llm import common, queries, sharding, simhash, topk


def plain_fingerprint(text, width=4) -> int:
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int], distance=4) -> list[int]:
    """For each row the number of its component."""
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    array = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= distance) + i + 1:
            a, b = top(i), top(int(j))
            parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def clustered(n: int, seed: int) -> list[int]:
    """Random fingerprints, chains of small steps and one dense cluster."""
    rng = random.Random(seed)
    found = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rng.choice(found)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << b
        found.append(x)
    found += [found[0] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(n)]
    return sorted(set(found))


def check_components(rows, docs):
    fps = [plain_fingerprint(t) for _, t in docs]
    names = plain_components(fps)
    least = {}
    for (d, _), c in zip(docs, names, strict=True):
        least[c] = min((x for x in (least.get(c), d) if x is not None), default=None)
    want = sorted((str(d), f"{f:016x}", str(least[c])) for (d, _), f, c in zip(docs, fps, names, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def test_gray_rank_orders_the_gray_code():
    codes = np.arange(4096, dtype=np.uint64)
    assert (simhash.gray_rank(codes ^ (codes >> np.uint64(1))) == codes).all()


@pytest.mark.parametrize("groups", [1, 7])
def test_index_finds_the_components_of_each_group(groups):
    fps = np.array(clustered(300, groups), np.uint64)
    group = np.arange(len(fps)) % groups
    order = np.lexsort((simhash.gray_rank(fps), group))
    fps, group = fps[order], group[order]
    root = simhash.GrayIndex(fps, group, 4).join()
    for g in range(groups):
        own = np.flatnonzero(group == g)
        want = plain_components(fps[own].tolist())
        assert len(set(zip(root[own].tolist(), want, strict=True))) == len(set(want)) == len(set(root[own].tolist()))


@pytest.mark.parametrize("limit", [20_000, 50])
def test_classes_of_clustered_fingerprints(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", limit)
    fps = clustered(250, 5)
    rows = spark.createDataFrame([(i, int(np.array(f, np.uint64).view(np.int64))) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(rows).collect()}
    want = plain_components(fps)
    assert [got[int(np.array(f, np.uint64).view(np.int64))] for f in fps] == want


def test_near_duplicates_of_odd_rows(odd_docs):
    check_components(simhash.near_duplicates(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_near_duplicates_of_the_table(spark, sf_dir, sf_docs):
    check_components(queries.op2_simhash_gray(spark, sf_dir).collect(), [(r.doc_id, r.text) for r in sf_docs.collect()])


def test_one_of_each_component_stays(odd_docs, sf_docs):
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    names = plain_components([plain_fingerprint(t) for _, t in docs])
    least = {}
    for (d, _), c in zip(docs, names, strict=True):
        least[c] = min((x for x in (least.get(c), d) if x is not None), default=None)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d in least.values())
    assert simhash.keep_first(sf_docs.union(sf_docs)).count() == simhash.keep_first(sf_docs).count()


def test_no_fingerprints(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.keep_first(no_docs).collect() == []


def check_shards(rows, shards, tolerance):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert all(0 <= s < shards and sorted(r.slot for r in own) == list(range(len(own))) for s, own in by.items())
    sizes = [sum(r["size"] for r in by.get(s, [])) for s in range(shards)]
    assert max(sizes) - sum(sizes) / shards <= tolerance


def test_shards_of_odd_rows(odd_docs):
    rows = sharding.shard(odd_docs, 4).collect()
    assert sorted((str(r.doc_id), r.text or "", r["size"]) for r in rows) == sorted((str(r.doc_id), r.text or "", len((r.text or "").encode()) + 1) for r in odd_docs.collect())
    assert set(rows[0].asDict()) == {*odd_docs.columns, "size", "shard", "slot"}
    check_shards(rows, 4, max(r["size"] for r in rows))


def test_shards_of_the_table(spark, sf_dir, sf_docs):
    rows = queries.op3_sampled_splitters(spark, sf_dir).collect()
    text = {r.doc_id: r.text.encode() for r in sf_docs.collect()}
    assert len(rows) == len(text) and all((r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]), "bytes", None) for r in rows)
    check_shards(rows, 16, max(r["size"] for r in rows))


def test_copies_are_divided_where_they_overfill_a_shard(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("a copy of some text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    rows = sharding.shard(docs, 16).collect()
    check_shards(rows, 16, sum(r["size"] for r in rows) / 16 * 0.05)
    assert sharding.shard(docs.limit(0), 16).collect() == []
    same = spark.range(100).select(F.lit(1).alias("doc_id"), F.lit("x").alias("text"))
    check_shards(sharding.shard(same, 4).collect(), 4, 1000)


def test_top_k_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    assert difference(queries.op8_norm_buckets(spark, sf), connect(sf), queries.ORACLES["op8_norm_buckets"]) == ""


def test_top_k_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "PART_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "BUCKET", 16)
    rng = np.random.default_rng(1)
    vectors = {i: (rng.standard_normal(8) * rng.choice([0.1, 1, 30])).tolist() for i in range(300)}
    vectors |= {i: [0.0] * 8 for i in range(300, 310)} | {i: vectors[7] for i in range(310, 400)}
    odd = [(400, None), (420, [1.0, None] + [0.0] * 6), (440, [float("nan")] * 8), (460, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (401, [])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in [*vectors.items(), *odd]], "vec_id long, embedding array<double>, key string, part int")
    got = {}
    for r in topk.top_k(table, F.col("vec_id") % 20 == 0, k=7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.floor(64 * np.array(v)).astype(np.int64) for i, v in vectors.items()}
    want = {}
    for q in [i for i in whole if i % 20 == 0]:
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:7]
        want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert {q: sorted(r) for q, r in got.items()} == want
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []




@pytest.mark.parametrize(("spread", "most"), [(1.0, 0.25), (2.0, 0.1)])
def test_products_are_few_where_lengths_differ(spark, spread, most):
    """Thresholds pass between parts: shares of the products that all pairs would take."""
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((9_000, 16)) * np.exp(rng.normal(0, spread, (9_000, 1)))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    taken = spark.sparkContext.accumulator(0)
    got = {}
    for r in topk.top_k(table, F.col("vec_id") % 20 == 0, products=taken).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = np.floor(64 * vectors).astype(np.int64)
    assert len(got) == 450 and taken.value < most * 9_000 * 450
    for q, rows in got.items():
        scores = whole @ whole[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:20]
        assert sorted(rows) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


@pytest.mark.parametrize("biggest", [1.0, 5e2, 3e7, 1e14])
def test_top_k_of_large_numbers_is_exact(spark, monkeypatch, biggest):
    monkeypatch.setattr(topk, "PART_ROWS", 30)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(3)
    vectors = {i: (rng.standard_normal(4) * biggest / 4 / (1 + i % 9)).tolist() for i in range(200)}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    scale = 64.0 if biggest < 1e9 else 2**-16
    whole = {i: [int(np.floor(scale * x)) for x in v] for i, v in vectors.items()}
    got = {}
    for r in topk.top_k(table, F.col("vec_id") % 20 == 0, k=6, scale=scale).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, 200, 20):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i) for i in whole if i != q)[:6]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


@pytest.mark.parametrize(("blocks", "limit"), [(5, 30), (6, 20_000), (7, 40), (8, 20_000)])
def test_finer_buckets_find_the_same_classes(spark, monkeypatch, blocks, limit):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", limit)
    monkeypatch.setattr(simhash, "block_count", lambda n, distance: blocks)
    fps = clustered(200, 6)
    rows = spark.createDataFrame([(i, int(np.array(f, np.uint64).view(np.int64))) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(rows).collect()}
    assert [got[int(np.array(f, np.uint64).view(np.int64))] for f in fps] == plain_components(fps)


def test_buckets_grow_in_bits_and_not_in_rows():
    for n in (10, 10**6, 10**8, 10**10, 10**12):
        blocks = simhash.block_count(n, 4)
        bits = sum(sorted(simhash._widths(blocks))[: blocks - 4])
        assert n <= simhash.BUCKET_MEAN << bits
    assert [simhash.block_count(n, 4) for n in (10, 8 * 10**6, 10**9)] == [5, 5, 6]


def test_a_hot_key_is_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST_HOT", 50)
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"), F.create_map(F.lit("id"), F.col("id")).alias("m"), F.lit("x").alias("salt"))
    right = spark.range(0, 500, 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = common.join_unique(left, right, "k", 2000)
    assert got.columns == ["k", "m", "salt", "v"]
    want = sorted((r.k, r.m["id"], r.v) for r in left.join(right, "k").collect())
    assert sorted((r.k, r.m["id"], r.v) for r in got.collect()) == want and len(want) > 600


def test_columns_that_have_no_hash(spark, odd_docs):
    extra = odd_docs.withColumn("m", F.create_map(F.lit("a"), F.col("doc_id"))).withColumn("v", F.to_variant_object(F.struct("doc_id"))).withColumn("deep", F.array(F.struct("m")))
    assert simhash.keep_first(extra).count() == simhash.keep_first(odd_docs).count()
    assert sorted(r.slot for r in sharding.shard(extra, 1).select("slot").collect()) == list(range(odd_docs.count()))
