"""Daily reliability of stations and routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.functions.calendar import LATE, LATE_AFTER_MINUTES


def train_daily_status(
    df: DataFrame,
    dims: Sequence[str],
    train: str = "train_id",
    ts: str = "actual_timestamp",
    delay: str = "delay_minutes",
    status: str = "variation_status",
    on_time_rule: str = "reference",
    late: int = LATE_AFTER_MINUTES,
) -> DataFrame:
    """Worst delay per train, ``dims``, day and status, labelled ON_TIME or LATE.

    Rule ``reference``: on time means reported late by at most ``late`` minutes;
    every other status counts as LATE, early and unknown ones too. Rule
    ``signed``: a status other than late, or a delay of at most ``late`` minutes,
    is on time; cancelled and unknown ones are not.
    """
    if on_time_rule not in ("reference", "signed"):
        raise ValueError(f"on_time_rule must be reference or signed, not {on_time_rule!r}")
    worst = (
        df.withColumn("date", F.to_date(ts))
        .groupBy(train, *dims, "date", status)
        .agg(F.max(delay).alias("final_delay_minutes"))
    )
    small = F.col("final_delay_minutes") <= late
    on_time = small & (F.col(status) == LATE)
    if on_time_rule == "signed":
        on_time = on_time | F.col(status).isin("EARLY", "ON TIME")
    return worst.withColumn("train_status", F.when(on_time, "ON_TIME").otherwise("LATE"))


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2)


def reliability_metrics(df: DataFrame, dims: Sequence[str], train: str = "train_id", **options) -> DataFrame:
    """Scheduled, on-time and late trains, mean delay and reliability per ``dims`` and day.

    Trains are counted once per group and label; a train seen both on time and
    late counts in both. The distinct counts are taken by first collapsing to one
    row per train, so Spark needs no row-multiplying ``Expand`` and every step
    aggregates before it shuffles.
    """
    status = train_daily_status(df, dims, train, **options)
    known = F.col(train).isNotNull()
    per_train = status.groupBy(*dims, "date", train).agg(
        F.max(F.when(F.col("train_status") == "ON_TIME", 1).otherwise(0)).alias("_on_time"),
        F.max(F.when(F.col("train_status") == "LATE", 1).otherwise(0)).alias("_late"),
        F.sum("final_delay_minutes").alias("_delay"),
        F.count("final_delay_minutes").alias("_delays"),
    )
    return (
        per_train.groupBy(*dims, "date")
        .agg(
            F.count(train).alias("scheduled_trains"),
            F.sum(F.when(known, F.col("_on_time")).otherwise(0)).alias("on_time_trains"),
            F.sum(F.when(known, F.col("_late")).otherwise(0)).alias("late_trains"),
            F.sum("_delay").alias("_delay"),
            F.sum("_delays").alias("_delays"),
        )
        .select(
            *dims,
            "date",
            "scheduled_trains",
            "on_time_trains",
            "late_trains",
            F.round(F.try_divide(F.col("_delay"), F.col("_delays")), 2).alias("avg_delay"),
            percent(F.col("on_time_trains"), F.col("scheduled_trains")).alias("reliability_index"),
        )
    )
