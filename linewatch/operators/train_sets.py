"""Daily reliability from mergeable sets of trains.

A summary holds, per place, day, status and delay, the trains reported so, as bitmaps
of train numbers. Summaries of different movements merge by OR, in any order and
as often as one likes, so late movements update a day without a look at the
others; all metrics follow from the summary alone. Sets can't forget: a movement that is
replaced, not added, needs its day built anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewatch.functions.calendar import LATE, LATE_AFTER_MINUTES
from linewatch.operators.reliability import percent

SUMMARY = ["status", "delay", "bucket"]
# Numbers of one bucket. A set is as long as its bucket, however few trains it has, and most sets have few.
BUCKET, WORD = 512, 64


def number_trains(trains: DataFrame, known: DataFrame | None = None, train: str = "train_id") -> DataFrame:
    """``train, number`` of the trains in ``trains`` that ``known`` does not have, numbered from its greatest number on.

    Numbers are dense but for the gaps of a task, so that sets stay small. Tasks number their own trains, each from
    where the one before ends; only their counts, one a task, reach the driver.
    """
    new = trains.select(F.col(train).alias("train")).where("train IS NOT NULL").distinct()
    first = 0
    if known is not None:
        new = new.join(known.select("train"), "train", "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    # by hash, so that a repeated task gets the same trains
    placed = new.withColumn("part", F.pmod(F.xxhash64("train"), F.lit(256)))
    counts = {r.part: r.n for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, at = [], first
    for part in range(256):
        starts.append(at)
        at += counts.get(part, 0)
    rank = F.row_number().over(Window.partitionBy("part").orderBy("train"))
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), (F.col("part") + 1).cast("int"))
    return placed.select("train", (start + rank - 1).alias("number"))


def _place(rows: DataFrame) -> list[str]:
    """What rows are dealt to tasks by before they become sets: place, day and bucket.

    Spark's bitmap aggregates hold 4096 bytes a group. With all rows of a group in one task these bytes
    are neither sorted nor shuffled, and all later steps but the last find their rows together.
    """
    return [c for c in rows.columns if c not in ("status", "delay", "bit", "trains")]


def _short(bitmap: Column) -> Column:
    return F.substring(bitmap, 1, BUCKET // 8)


def train_sets(
    df: DataFrame,
    dims: Sequence[str],
    numbers: DataFrame | None = None,
    train: str = "train_id",
    ts: str = "actual_timestamp",
    delay: str = "delay_minutes",
    status: str = "variation_status",
) -> DataFrame:
    """The summary of movements: ``dims, date, status, delay, bucket, trains``.

    ``numbers`` has the number of each train (see :func:`number_trains`); without it the trains
    are numbers themselves. ``trains`` is the set of those of one bucket of 512 numbers, 64 bytes; movements
    without a train have a bucket of their own, which is null.
    """
    rows = df.select(*dims, F.to_date(ts).alias("date"), F.col(status).alias("status"), F.col(delay).cast("int").alias("delay"), F.col(train).alias("_train"))
    if numbers is None:
        rows = rows.withColumn("_number", F.col("_train").cast("long"))
    else:
        rows = rows.join(numbers.select(F.col("train").alias("_train"), F.col("number").alias("_number")), "_train", "left")
    # a bit is set once; this also cuts repeated reports before the shuffle
    rows = rows.select(*dims, "date", "status", "delay", "_number").distinct()
    number = F.coalesce("_number", F.lit(0))
    # Spark's buckets hold 32768 numbers: each is cut into 64
    at = F.bitmap_bit_position(number)
    bucket = F.when(F.col("_number").isNotNull(), F.bitmap_bucket_number(number) * (32768 // BUCKET) + F.floor(at / BUCKET))
    rows = rows.select(*dims, "date", "status", "delay", bucket.alias("bucket"), (at % BUCKET).alias("bit"))
    rows = rows.repartition(*_place(rows))
    return rows.groupBy(*dims, "date", *SUMMARY).agg(_short(F.bitmap_construct_agg("bit")).alias("trains"))


def merge_sets(summary: DataFrame, *others: DataFrame) -> DataFrame:
    """One summary of all that several hold."""
    for other in others:
        summary = summary.unionByName(other)
    keys = [c for c in summary.columns if c != "trains"]
    together = summary.repartition(*_place(summary))
    return together.groupBy(*keys).agg(_short(F.bitmap_or_agg("trains")).alias("trains"))


def metrics_of_sets(
    summary: DataFrame, dims: Sequence[str], on_time_rule: str = "reference", late: int = LATE_AFTER_MINUTES
) -> DataFrame:
    """What :func:`~linewatch.operators.reliability.reliability_metrics` gives, from a summary.

    A train's last delay is its greatest per status. Late reports within ``late`` minutes and without
    a greater one are on time. The sum of greatest delays is, over the delays from the greatest down, each times the
    trains not met before. Sets that are not merged yet give the same. They are taken as words of 64 trains, those without any left out.
    """
    if on_time_rule not in ("reference", "signed"):
        raise ValueError(f"on_time_rule must be reference or signed, not {on_time_rule!r}")
    key = [*dims, "date"]
    is_late = F.coalesce(F.col("status") == LATE, F.lit(False))
    early = F.coalesce(F.col("status").isin("EARLY", "ON TIME"), F.lit(False)) if on_time_rule == "signed" else F.lit(False)
    kind = (
        F.when(early, "early")
        .when(~is_late, "other")
        .when(F.col("delay") <= late, "small")
        .when(F.col("delay") > late, "great")
        .otherwise("unknown")
    )
    words = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKET // WORD - 1)),
        lambda w: F.struct(w.alias("word"), F.substring(F.col("trains"), w * (WORD // 8) + 1, F.lit(WORD // 8)).alias("bits")),
    )
    some = F.explode(F.filter(words, lambda w: w["bits"] != F.lit(bytearray(WORD // 8))))
    sets = summary.select(*key, *SUMMARY, some.alias("w")).select(
        *key, *SUMMARY, F.col("w.word").alias("word"), F.conv(F.hex("w.bits"), 16, -10).cast("long").alias("bits")
    )
    # delays from the greatest down: the trains met so far
    down = Window.partitionBy(*key, "bucket", "word", "status").orderBy(F.col("delay").desc())
    met = F.coalesce(F.bit_or("bits").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sets = sets.withColumn("new", F.when(F.col("delay").isNotNull(), F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(met))).cast("long")))
    # movements without a train count in no set, but keep their place's row
    of_trains = F.when(F.col("bucket").isNotNull(), kind)
    kinds = ("early", "other", "small", "great", "unknown")
    per_word = sets.withColumn("kind", of_trains).groupBy(*key, "bucket", "word").agg(
        *[F.coalesce(F.bit_or(F.when(F.col("kind") == k, F.col("bits"))), F.lit(0).cast("long")).alias(k) for k in kinds],
        F.sum(F.col("delay") * F.col("new")).alias("delay"),
        F.sum("new").alias("delays"),
    )

    def count(some: Sequence[str], without: Sequence[str] = ()) -> Column:
        either = reduce(Column.bitwiseOR, [F.col(k) for k in some])
        for k in without:
            either = either.bitwiseAND(F.bitwise_not(F.col(k)))
        return F.sum(F.bit_count(either))

    total = per_word.groupBy(*key).agg(
        count(kinds).alias("scheduled"),
        (count(["small"], ["great", "early"]) + count(["early"])).alias("on_time"),
        (count(["other", "great"]) + count(["unknown"], ["small", "other", "great"])).alias("late"),
        F.sum("delay").alias("delay"),
        F.sum("delays").alias("delays"),
    )
    return total.select(
        *key,
        F.col("scheduled").alias("scheduled_trains"),
        F.col("on_time").alias("on_time_trains"),
        F.col("late").alias("late_trains"),
        F.round(F.try_divide(F.col("delay"), F.col("delays")), 2).alias("avg_delay"),
        percent(F.col("on_time"), F.col("scheduled")).alias("reliability_index"),
    )
