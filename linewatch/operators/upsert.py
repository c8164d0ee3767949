"""Keyed upsert and set-based update of marks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.schemas import conform


def _same_key(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe: bool, prefix: str = "_k_") -> Column:
    pairs = [(a[k], b[prefix + k]) for k in keys]
    return reduce(
        lambda x, y: x & y,
        [(x.eqNullSafe(y) if null_safe else x == y) for x, y in pairs],
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    preserve: Sequence[str] = (),
    newer_by: str | None = None,
) -> DataFrame:
    """``target`` with rows of equal ``keys`` replaced by ``source`` and new ones added.

    ``source`` is put into the target's columns by name and must be unique on
    ``keys``. NULL key parts count as equal when ``null_safe``, so a second run
    adds nothing. ``preserve`` columns keep the target's value on replaced rows. With
    ``newer_by`` a row whose value there is older than the target's (unknown is
    oldest) is left out, so batches may come in any order.

    Only key columns of ``source`` meet the target: an anti join finds the rows to
    keep, and with a source small enough to broadcast the target is not shuffled.
    """
    source = conform(source, dict(target.dtypes))
    if newer_by:
        held = target.select(*[F.col(k).alias("_k_" + k) for k in keys], F.col(newer_by).alias("_held_at"))
        newer = (held["_held_at"] > source[newer_by]) | (source[newer_by].isNull() & held["_held_at"].isNotNull())
        source = source.join(held, _same_key(source, held, keys, null_safe) & newer, "left_anti")
    marks = source.select(*[F.col(k).alias("_k_" + k) for k in keys])
    kept = target.join(marks, _same_key(target, marks, keys, null_safe), "left_anti")
    if preserve:
        held = target.join(marks, _same_key(target, marks, keys, null_safe), "left_semi").select(
            *[F.col(k).alias("_k_" + k) for k in keys],
            *[F.col(c).alias("_held_" + c) for c in preserve],
            F.lit(True).alias("_is_held"),
        )
        joined = source.join(held, _same_key(source, held, keys, null_safe), "left")
        source = joined.select(
            *[
                (F.when(F.col("_is_held"), F.col("_held_" + c)).otherwise(source[c]).alias(c) if c in preserve else source[c])
                for c in target.columns
            ]
        )
    return kept.unionByName(source)


def mark_notified(alerts: DataFrame, processed: DataFrame, at: Column | None = None) -> DataFrame:
    """Alerts whose ``event_id`` is in ``processed`` become SENT, notified ``at``."""
    done = processed.select(F.col("event_id").alias("_done_id")).distinct().withColumn("_done", F.lit(True))
    when = F.current_timestamp() if at is None else at
    hit = F.col("_done").isNotNull()
    return (
        alerts.join(done, alerts["event_id"] == done["_done_id"], "left")
        .withColumns(
            {
                "notification_status": F.when(hit, F.lit("SENT")).otherwise(F.col("notification_status")),
                "notified_at": F.when(hit, when).otherwise(F.col("notified_at")),
            }
        )
        .drop("_done", "_done_id")
    )
