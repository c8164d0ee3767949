"""Intervals in short steps, and ranges that become blocks without a walk over all levels."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linewatch.operators.ranges import locate, prefix_blocks
from linewatch.operators.temporal import interval_join

T = datetime(2024, 1, 1)


@pytest.mark.parametrize("before, after", [(0, 0), (0.25, 0), (1, 0), (2.5, 1.25), (0, 7), (60, 3), (1800, 0)])
def test_each_pair_in_reach_is_met_once(table, before, after):
    rng = random.Random(1)
    reach = before + after
    spot = lambda: T + timedelta(seconds=rng.choice([rng.randrange(int(reach * 12) + 8) / 4, rng.randrange(5) * reach]))
    left, right = ([(i, rng.choice("xy"), spot()) for i in range(60)] for _ in range(2))
    l, r = table("i int, city string, ts timestamp", *left), table("j int, city string, seen timestamp", *right)
    got = interval_join(l, r, ["city"], "ts", "seen", before=timedelta(seconds=before), after=timedelta(seconds=after), how="inner")
    want = [(i, j) for i, c, t in left for j, d, s in right if c == d and -before <= (s - t).total_seconds() <= after]
    assert want and sorted((x.i, x.j) for x in got.collect()) == sorted(want)


def test_few_pairs_out_of_reach_are_looked_at(spark):
    """A row meets steps that are little longer than its interval; before, they were twice as long."""
    moves = spark.range(400).select(F.lit("x").alias("city"), F.timestamp_add("SECOND", F.col("id").cast("int") * 60, F.lit(T)).alias("ts"))
    df = interval_join(moves, moves.withColumnRenamed("ts", "seen"), ["city"], "ts", "seen", before=timedelta(minutes=60), how="inner")
    pair = df._jdf.queryExecution().analyzed().toString()
    assert pair.count("cast(900 as bigint)") >= 2 or "/ cast(900" in pair or "/ 900" in pair


def test_short_ranges_take_few_levels(table):
    df = table("a bigint, b bigint", (7, 7), (8, 15), (1, 100), (9, 8), (None, 3), (3, None), (0, 2**32 - 1), (2**31, 2**32 - 1))
    found = [sorted((x.level, x.prefix) for x in r[0]) for r in df.select(prefix_blocks(F.col("a"), F.col("b"))).collect()]
    assert found[:2] == [[(0, 7)], [(3, 1)]] and found[3:] == [[], [], [], [(32, 0)], [(31, 1)]]
    plan = df.select(prefix_blocks(F.col("a"), F.col("b")))._jdf.queryExecution().toString()
    assert "aggregate(" not in plan


def test_all_tasks_cut_ranges(table):
    df, known = table("address bigint", (5,)), table("range_start bigint, range_end bigint, place string", (1, 9, "p"))
    plan = locate(df, known, "address", ["place"])._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
