"""Reliability from mergeable sets equals that from all movements."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from linewatch.operators.reliability import reliability_metrics
from linewatch.operators.train_sets import merge_sets, metrics_of_sets, number_trains, train_sets

MOVES = "train_id string, route string, actual_timestamp timestamp, delay_minutes int, variation_status string"


def random_moves(n, trains=30, seed=1):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, *map(str, range(trains))]),
            rng.choice(["R", "S", None]),
            rng.choice([datetime(2024, 5, 1, 8), datetime(2024, 5, 2, 23, 59), None]),
            rng.choice([None, -7, 0, 3, 5, 6, 20, rng.randrange(60)]),
            rng.choice(["LATE", "LATE", "EARLY", "ON TIME", "CANCELLED", None]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("rule", ["reference", "signed"])
@pytest.mark.parametrize("trains", [3, 40])
def test_any_split_gives_what_all_movements_give(table, rows, rule, trains):
    moves = random_moves(600, trains)
    every = table(MOVES, *moves)
    want = rows(reliability_metrics(every, ["route"], on_time_rule=rule))
    numbers = number_trains(every)
    parts = [train_sets(table(MOVES, *moves[i::3]), ["route"], numbers) for i in range(3)]
    again = merge_sets(parts[2], merge_sets(parts[1], parts[0]), parts[2])  # in any order, one part twice
    assert rows(metrics_of_sets(again, ["route"], rule)) == want
    assert rows(metrics_of_sets(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["route"], rule)) == want


def test_small_cases(table, rows):
    def both(*moves):
        df = table(MOVES, *[(t, "R", datetime(2024, 5, 1), d, s) for t, d, s in moves])
        got = rows(metrics_of_sets(train_sets(df, ["route"], number_trains(df)), ["route"]))
        assert got == rows(reliability_metrics(df, ["route"]))
        return got[0][2:]

    assert both(("a", 3, "LATE"), ("a", 1, "LATE"), ("a", 9, "EARLY"), ("b", 20, "LATE")) == (2, 1, 2, 10.67, 50.0)
    assert both(("a", None, "LATE")) == (1, 0, 1, None, 0.0)
    assert both((None, 3, "LATE")) == (0, 0, 0, 3.0, None)
    assert both(("a", 3, "LATE"), ("a", 9, "LATE")) == (1, 0, 1, 9.0, 0.0)
    assert both(("a", None, "LATE"), ("a", 4, "LATE")) == (1, 1, 0, 4.0, 100.0)


def test_trains_of_several_buckets_that_are_numbers_themselves(spark, rows):
    moves = spark.range(-40_000, 60_000, 7).select(
        F.col("id").alias("train_id"), F.lit("R").alias("route"), F.lit(datetime(2024, 5, 1)).alias("actual_timestamp"),
        F.pmod("id", F.lit(11)).cast("int").alias("delay_minutes"), F.lit("LATE").alias("variation_status"),
    )
    summary = train_sets(moves, ["route"])
    assert summary.select("bucket").distinct().count() >= 4
    assert rows(metrics_of_sets(summary, ["route"])) == rows(reliability_metrics(moves, ["route"]))


def test_nothing(table):
    assert metrics_of_sets(train_sets(table(MOVES), ["route"], number_trains(table(MOVES))), ["route"]).collect() == []
    with pytest.raises(ValueError):
        metrics_of_sets(train_sets(table(MOVES), ["route"]), ["route"], "other")


def test_numbers_are_dense_and_kept(table):
    first = table("train_id string", *[(f"t{i % 500}",) for i in range(900)], (None,))
    known = number_trains(first).cache()
    assert sorted(r.number for r in known.collect()) == list(range(500))
    more = number_trains(table("train_id string", *[(f"t{i}",) for i in range(450, 600)]), known)
    assert sorted(r.number for r in more.collect()) == list(range(500, 600))
    assert {r.train for r in more.collect()} == {f"t{i}" for i in range(500, 600)}


def test_sets_combine_before_they_are_shuffled(table):
    df = table(MOVES, *random_moves(50))
    plan = merge_sets(train_sets(df, ["route"], number_trains(df)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_or_agg" in plan and "partial_bitmap_construct_agg" in plan and "Expand" not in plan


def test_sets_are_short_and_bitmaps_of_spark_are_not_shuffled(table):
    df = table(MOVES, *random_moves(300))
    summary = merge_sets(*(train_sets(df.where(w), ["route"], number_trains(df)) for w in ("delay_minutes < 20", "delay_minutes >= 20")))
    assert {r[0] for r in summary.select(F.length("trains")).collect()} == {64}
    plan = metrics_of_sets(summary, ["route"])._jdf.queryExecution().executedPlan().toString().splitlines()
    partial = [i for i, line in enumerate(plan) if "partial_bitmap_" in line]
    assert len(partial) >= 3 and all("SortAggregate" in plan[i - 1] for i in partial)


def test_each_bit_of_a_set_is_met(spark, rows):
    """Both ends of words, sets and buckets; every train has two delays of a status, a word of its own or a full one."""
    ends = [x + d for x in (0, 64, 512, 32768, 65536, -512, -32768) for d in range(-2, 3)] + [*range(1025, 1090)]
    moves = spark.createDataFrame([(n,) for n in sorted(set(ends))], "train_id long").select(
        "train_id", F.lit("R").alias("route"), F.lit(datetime(2024, 5, 1)).alias("actual_timestamp"),
        F.explode(F.array(*[F.pmod("train_id", F.lit(n)).cast("int") for n in (13, 4)])).alias("delay_minutes"),
        F.element_at(F.array(F.lit("LATE"), F.lit("EARLY"), F.lit(None)), (F.pmod("train_id", F.lit(3)) + 1).cast("int")).alias("variation_status"),
    )
    for rule in ("reference", "signed"):
        assert rows(metrics_of_sets(train_sets(moves, ["route"]), ["route"], rule)) == rows(reliability_metrics(moves, ["route"], on_time_rule=rule))
