import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linewatch.operators.temporal import asof_join, interval_join

T0 = datetime(2024, 3, 1, 12, 0, 0)
HALF_HOUR, THREE_HOURS = timedelta(minutes=30), timedelta(hours=3)


def at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def sides(table, left, right):
    """left: (id, city, second), right: (city, second, value)"""
    l = table("id int, city string, ts timestamp_ntz", *[(i, c, at(s)) for i, c, s in left])
    r = table("city string, seen timestamp_ntz, value int", *[(c, at(s), v) for c, s, v in right])
    return l, r


def brute(left, right, tolerance, forward):
    out = []
    for i, c, s in left:
        best = None
        for rc, rs, v in right:
            if s is None or rs is None or c is None or rc != c:
                continue
            gap = rs - s if forward else s - rs
            if 0 <= gap <= tolerance.total_seconds():
                key = (-gap, v)
                if best is None or key > best[0]:
                    best = (key, v)
        out.append((i, best[1] if best else None))
    return sorted(out, key=str)


def run(table, left, right, tolerance=HALF_HOUR, direction="backward", **how):
    l, r = sides(table, left, right)
    joined = asof_join(
        l, r, ["city"], "ts", "seen", tolerance, direction, tie_order=[F.col("value").desc()], **how
    )
    assert joined.columns == ["id", "city", "ts", "seen", "value"]
    return sorted(((x.id, x.value) for x in joined.collect()), key=str)


WAYS = [{}, {"sub_second": False}]


@pytest.mark.parametrize("how", WAYS)
def test_backward_ends_and_ties(table, how):
    left = [
        (1, "A", 0), (2, "A", 1800), (3, "A", 1801), (4, "B", 10), (5, None, 10), (6, "A", None), (7, "A", -1), (8, "A", 700),
    ]
    right = [("A", 0, 1), ("A", 0, 2), ("A", 600, 3), ("A", 700, 4), ("B", 11, 5), (None, 10, 6), ("A", None, 7)]
    left.append((9, "A", 2500))
    left.append((10, "A", 2501))
    expected = brute(left, right, HALF_HOUR, False)
    assert expected == sorted(
        [(1, 2), (2, 4), (3, 4), (4, None), (5, None), (6, None), (7, None), (8, 4), (9, 4), (10, None)], key=str
    )
    assert run(table, left, right, **how) == expected


@pytest.mark.parametrize("how", WAYS)
def test_forward_ends_and_ties(table, how):
    left = [(1, "A", 0), (2, "A", -10800), (3, "A", -10801), (4, "A", 1), (5, "B", 0), (6, "A", 60)]
    right = [("A", 0, 1), ("A", 0, 9), ("A", 60, 3)]
    expected = brute(left, right, THREE_HOURS, True)
    assert expected == sorted([(1, 9), (2, 9), (3, None), (4, 3), (5, None), (6, 3)], key=str)
    assert run(table, left, right, THREE_HOURS, "forward", **how) == expected


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("tolerance", [timedelta(seconds=7), HALF_HOUR])
def test_all_ways_agree_with_brute_force(table, direction, tolerance):
    rng = random.Random(f"{direction}{tolerance}")
    span = 60 if tolerance < HALF_HOUR else 9000
    # A third of all rows sits in one city at one instant.
    left = [(i, rng.choice("ABC"), rng.randint(-span, span) + rng.choice([0, 0.25])) for i in range(80)]
    left += [(100 + i, "A", 5) for i in range(40)]
    right = [(rng.choice("ABC"), rng.randint(-span, span) + rng.choice([0, 0.25]), i) for i in range(60)]
    right += [("A", 4, 100 + i) for i in range(30)]
    expected = brute(left, right, tolerance, direction == "forward")
    for how in WAYS:
        assert run(table, left, right, tolerance, direction, **how) == expected, how


def test_no_observations_keep_all_events(table):
    assert run(table, [(1, "A", 0), (1, "A", 0)], []) == [(1, None), (1, None)]


def test_equal_events_all_stay(table):
    assert run(table, [(1, "A", 5), (1, "A", 5)], [("A", 5, 7)]) == [(1, 7), (1, 7)]


def test_zoned_timestamps_over_a_clock_change(spark):
    """Instants an hour apart show the same wall clock when summer time ends."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        first, second = 1729987200 + 600, 1729990800 + 600
        left = spark.createDataFrame([(1, "A", second)], "id int, city string, s long")
        right = spark.createDataFrame([("A", first, 1), ("A", second - 60, 2)], "city string, s long, value int")
        joined = asof_join(
            left.select("id", "city", F.timestamp_seconds("s").alias("ts")),
            right.select("city", F.timestamp_seconds("s").alias("seen"), "value"),
            ["city"], "ts", "seen", HALF_HOUR,
        )
        assert [r.value for r in joined.collect()] == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_wrong_arguments(table):
    l, r = sides(table, [(1, "A", 0)], [("A", 0, 1)])
    with pytest.raises(ValueError):
        asof_join(l, r, ["city"], "ts", "seen", HALF_HOUR, "sideways")
    for kind in ("right", "full", "outer", "magic"):
        with pytest.raises(ValueError):
            interval_join(l, r, ["city"], "ts", "seen", before=HALF_HOUR, how=kind)


def test_interval_join_is_every_pair_in_reach(table):
    rng = random.Random(3)
    left = [(i, rng.choice("AB"), rng.randint(-5000, 5000)) for i in range(50)] + [(99, "A", None)]
    right = [(rng.choice("AB"), rng.randint(-5000, 5000), i) for i in range(50)]
    l, r = sides(table, left, right)
    joined = interval_join(l, r, ["city"], "ts", "seen", before=HALF_HOUR, after=timedelta(minutes=5))
    expected = []
    for i, c, s in left:
        hits = [v for rc, rs, v in right if s is not None and rc == c and s - 1800 <= rs <= s + 300]
        expected += [(i, v) for v in hits] or [(i, None)]
    assert sorted(((x.id, x.value) for x in joined.collect()), key=str) == sorted(expected, key=str)


def test_plans_pair_nothing_and_bound_every_group(table):
    """Scan joins on keys only; its windows run per city and block."""
    l, r = sides(table, [(1, "A", 0)], [("A", 0, 1)])
    plan = asof_join(l, r, ["city"], "ts", "seen", HALF_HOUR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "_block" in plan
