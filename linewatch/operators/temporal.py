"""Joins on time: all rows within an interval, and the nearest row (as-of)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewatch.functions.casts import second_count
from linewatch.operators.clean import dedupe, require


# Steps of an interval. A right row stands in one more, and of STEPS + 1 pairs that are looked at one is out of reach.
STEPS = 4
INTERVAL_KINDS = ("left", "inner", "left_semi", "left_anti")


def _interval(span: timedelta) -> Column:
    return F.make_dt_interval(
        F.lit(span.days), F.lit(0), F.lit(0), F.lit(span.seconds + span.microseconds / 1e6)
    )


def _whole_seconds(span: timedelta) -> int:
    return max(1, math.ceil(span.total_seconds()))


def _dtype(df: DataFrame, col: str) -> str:
    return dict(df.dtypes)[col]


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: timedelta = timedelta(0),
    after: timedelta = timedelta(0),
    how: str = "left",
) -> DataFrame:
    """All pairs with equal ``by`` and ``right_ts`` in ``[left_ts-before, left_ts+after]``.

    Time is cut into steps of a quarter of the interval, so an interval touches five
    steps. Right rows go to the steps whose intervals can reach them, left
    rows stay single, and the pair is found by an equi join on (``by``, step): four of five pairs that meet are in reach.
    ``right`` brings ``right_ts`` and its other columns; its ``by`` is dropped.
    ``how`` is left, inner, left_semi or left_anti: a right row stands in several
    steps, so unmatched right rows can't be told here.
    """
    if how not in INTERVAL_KINDS:
        raise ValueError(f"how must be one of {INTERVAL_KINDS}, not {how!r}")
    width = _whole_seconds((before + after) / STEPS)
    beyond = math.ceil((before + after) / timedelta(seconds=width))
    lo = F.col(left_ts) - _interval(before)
    hi = F.col(left_ts) + _interval(after)
    step = F.floor(second_count(lo, _dtype(left, left_ts)) / width)
    probe = left.withColumns({"_lo": lo, "_hi": hi, "_step": step})

    home = F.floor(second_count(F.col(right_ts), _dtype(right, right_ts)) / width)
    renamed = {c: f"_r_{c}" for c in by}
    reach = (
        require(right, *by, right_ts)
        .withColumnsRenamed(renamed)
        .withColumn("_r_step", F.explode(F.array(*[home - n for n in range(beyond + 1)])))
    )
    same = probe["_step"] == reach["_r_step"]
    for c in by:
        same = same & (probe[c] == reach[f"_r_{c}"])
    hit = same & reach[right_ts].between(probe["_lo"], probe["_hi"])
    return probe.join(reach, hit, how).drop("_lo", "_hi", "_step", "_r_step", *renamed.values())


def _scan(
    probes: DataFrame,
    points: DataFrame,
    by: Sequence[str],
    width: int,
    dtype: str,
    forward: bool,
    carry: DataFrame | None = None,
) -> DataFrame:
    """For every (``by``, ``at``) of ``probes`` the nearest ``at`` of ``points``.

    Rows meet per (``by``, block of ``width`` seconds). Within a block a running
    maximum (minimum when looking forward) carries the last point along; what
    comes from outside the block is one row, placed in front of it. That row is
    the neighbouring block's best point, or ``carry`` when given.
    """
    best = F.min if forward else F.max
    block = F.floor(second_count(F.col("at"), dtype) / width)
    probes = probes.withColumn("_block", block)
    points = points.withColumn("_block", block)
    if carry is None:
        edge = points.groupBy(*by, "_block").agg(best("at").alias("hit"))
        carry = edge.withColumn("_block", F.col("_block") + (-1 if forward else 1))
    rows = (
        points.select(*by, "_block", "at", F.lit(1).alias("_kind"), F.col("at").alias("hit"))
        .unionByName(probes.select(*by, "_block", "at", F.lit(2).alias("_kind"), F.lit(None).cast(dtype).alias("hit")))
        .unionByName(carry.select(*by, "_block", F.lit(None).cast(dtype).alias("at"), F.lit(0).alias("_kind"), "hit"))
    )
    travel = F.col("at").desc_nulls_first() if forward else F.col("at").asc_nulls_first()
    so_far = (
        Window.partitionBy(*by, "_block")
        .orderBy(travel, "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn("hit", best("hit").over(so_far)).where("_kind = 2").select(*by, "at", "hit")


def nearest_instants(
    probes: DataFrame,
    points: DataFrame,
    by: Sequence[str],
    tolerance: timedelta,
    dtype: str,
    forward: bool = False,
    sub_second: bool = False,
) -> DataFrame:
    """``by, at, hit``: the nearest point of each probe instant, within ``tolerance``.

    Both inputs are distinct (``by``, ``at``). One pass over blocks as long as
    the tolerance suffices: a point in reach lies in the probe's block or the one
    next to it. A block holds at most one row per second and side, however the
    data is skewed. With ``sub_second`` instants, a first pass over whole seconds
    finds what each second inherits and a second pass works inside one second,
    which keeps the same bound.
    """
    width = _whole_seconds(tolerance)
    if not sub_second:
        found = _scan(probes, points, by, width, dtype, forward)
    else:
        second = F.floor(second_count(F.col("at"), dtype))
        best, start = (F.min, F.max) if forward else (F.max, F.min)
        # A second's probes inherit from the seconds already passed. Standing at
        # the edge of the second (its first instant in travel order) on the probe
        # side and at the best point on the other keeps the passes consistent.
        edges = probes.withColumn("_second", second).groupBy(*by, "_second").agg(start("at").alias("at"))
        ends = points.withColumn("_second", second).groupBy(*by, "_second").agg(best("at").alias("at"))
        inherited = _scan(edges.select(*by, "at"), ends.select(*by, "at"), by, width, dtype, forward)
        carry = inherited.withColumn("_block", second).select(*by, "_block", "hit")
        found = _scan(probes, points, by, 1, dtype, forward, carry=carry)
    reach = F.col("at") + _interval(tolerance) if forward else F.col("at") - _interval(tolerance)
    within = F.col("hit") <= reach if forward else F.col("hit") >= reach
    return found.where(within)


def _content(df: DataFrame, keys: Sequence[str]) -> Column:
    """A fixed order among rows of equal keys, taken from their other columns."""
    others = [c for c, t in df.dtypes if c not in keys and "map<" not in t]
    return F.xxhash64(*others) if others else F.lit(0)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    tolerance: timedelta,
    direction: str = "backward",
    tie_order: Sequence[Column] = (),
    right_unique: bool = False,
    sub_second: bool = True,
    instants: DataFrame | None = None,
) -> DataFrame:
    """Every left row with the nearest right row of the same ``by`` in time.

    ``backward`` takes the newest right row in ``[left_ts - tolerance, left_ts]``,
    ``forward`` the earliest in ``[left_ts, left_ts + tolerance]``; both ends
    count. Unmatched left rows stay, with NULLs. Right rows sharing (``by``,
    ``right_ts``) are cut to the first by ``tie_order``, then by content, so that a
    repeated task picks the same one; ``right_unique`` says there are none.

    Rows are never paired: the join reduces both sides to distinct instants, finds
    each instant's partner with a running maximum over short blocks, fetches the
    partner's columns once per instant and joins them onto the left rows. The
    left rows are shuffled once at most; the side they meet is unique per key, so
    Spark's skew handling can split a hot key freely. Where ``left`` is costly,
    ``instants`` names a cheaper frame that holds all its ``by`` and ``left_ts``.

    Where both sides hold whole seconds only, ``sub_second=False`` saves the pass that
    bounds blocks for finer instants; results are the same.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction!r}")
    forward = direction == "forward"
    by = list(by)
    known = require(right, *by, right_ts)

    dtype = _dtype(left, left_ts)
    probes = require(left if instants is None else instants, *by, left_ts).select(*by, F.col(left_ts).alias("at")).distinct()
    points = known.select(*by, F.col(right_ts).cast(dtype).alias("at"))
    if not right_unique:
        points = points.distinct()
        right = dedupe(known, [*by, right_ts], [*tie_order, _content(right, [*by, right_ts])])
    hits = nearest_instants(probes, points, by, tolerance, dtype, forward, sub_second)

    side = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    same = side[right_ts].cast(dtype) == hits["hit"]
    for c in by:
        same = same & (side[f"_r_{c}"] == hits[c])
    partner = hits.join(side, same).drop("hit", *[f"_r_{c}" for c in by])

    partner = partner.withColumnsRenamed({c: f"_p_{c}" for c in [*by, "at"]})
    here = left[left_ts] == partner["_p_at"]
    for c in by:
        here = here & (left[c] == partner[f"_p_{c}"])
    return left.join(partner, here, "left").drop("_p_at", *[f"_p_{c}" for c in by])
