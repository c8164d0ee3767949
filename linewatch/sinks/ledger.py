"""What was changed, and what was done with it: days touched by merges, batches already merged.

Ledgers are tables that only grow by rows of a few words: a merge notes the days it is about to
write, a later job takes the days that it has not yet worked on, and notes that when
it is done. A job that breaks off leaves its days to be taken again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.sinks.tables import append_table


def note_days(spark: SparkSession, touched: str, source: str, days: Iterable[date | None]) -> None:
    """Note in table ``touched`` that ``days`` of ``source`` are about to change.

    It comes before the change: a break between the two costs the consumer a needless look, never a day.
    """
    batch = uuid.uuid4().hex
    rows = [(source, day, batch) for day in days]
    if rows:
        noted = spark.createDataFrame(rows, "source string, event_date date, batch string").coalesce(1)
        append_table(noted.withColumn("touched_at", F.current_timestamp()), touched)


def open_days(touched: DataFrame, consumed: DataFrame, consumer: str, sources: Sequence[str]) -> DataFrame:
    """``source, event_date, batch`` of the notes that ``consumer`` has not yet dealt with."""
    done = consumed.where(F.col("consumer") == consumer).select("batch").distinct()
    return touched.where(F.col("source").isin(*sources)).select("source", "event_date", "batch").join(done, "batch", "left_anti")


def close_days(notes: DataFrame, consumed: str, consumer: str) -> None:
    """Note that ``consumer`` has dealt with the batches of ``notes``, which are settled already."""
    batches = notes.select("batch").distinct().coalesce(1)
    append_table(batches.select(F.lit(consumer).alias("consumer"), "batch", F.current_timestamp().alias("consumed_at")), consumed)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a stream keeps over restarts; a new checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def is_merged(spark: SparkSession, merged: str, stream: str, batch: int) -> bool:
    spark.catalog.refreshTable(merged)
    return not spark.table(merged).where((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()


def note_merged(spark: SparkSession, merged: str, stream: str, batch: int) -> None:
    row = spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch).cast("bigint").alias("batch"), F.current_timestamp().alias("merged_at"))
    append_table(row.coalesce(1), merged)
