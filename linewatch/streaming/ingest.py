"""Streaming writes: append to a table, or upsert batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linewatch.operators.clean import dedupe, newest
from linewatch.session import staging_folder
from linewatch.sinks import ledger
from linewatch.sinks.tables import merge_table


def append_stream(
    df: DataFrame,
    checkpoint: str,
    table: str | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    files: int | None = None,
) -> StreamingQuery:
    """Append everything available now, then stop; a restart goes on where it ended.

    With ``files`` each micro-batch writes so many files a partition, or fewer, however many splits
    its source has; without it each split writes its own.
    """
    if files:
        # a stream has no run-time rebalance: rows of one partition value and salt share a task
        salt = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if t in ("string", "timestamp", "bigint")]), F.lit(files))
        df = df.withColumn("_salt", salt).repartition(*partition_by, "_salt").drop("_salt")
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    return writer.toTable(table) if table else writer.start(path)


def drained(df: DataFrame) -> DataFrame:
    """What a stream gives for everything available now, as a batch frame.

    Written to a folder of its own in the shared checkpoint folder, which goes like that of a staged frame.
    """
    folder = staging_folder(df.sparkSession)
    append_stream(df, f"{folder}/marks", path=f"{folder}/rows").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")


def upsert_stream(
    df: DataFrame,
    checkpoint: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    preserve: Sequence[str] = (),
    partition_is_stable: bool = True,
    newer_by: str | None = None,
    touching: Callable[[list[tuple]], None] | None = None,
    merged: str | None = None,
    merge: Callable[..., None] | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch into ``table``.

    With ``newer_by`` a late row of an older time there changes nothing; without it the
    last batch wins.

    Within a batch the newest row per key by ``order`` wins; leave ``order`` out
    where ``prepare`` already returns one row per key. Repeating a batch
    after a failure writes the same rows again, so nothing is counted twice. With a table ``merged``
    the batches that were merged are noted there, and one that is asked for again is
    skipped. ``touching`` is that of :func:`~linewatch.sinks.tables.merge_table`, which ``merge`` may replace.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = ledger.stream_id(spark, checkpoint) if merged else ""
        if merged and ledger.is_merged(spark, merged, stream, number):
            return
        rows = prepare(batch) if prepare else batch
        (merge or merge_table)(
            dedupe(rows, keys, newest(*order)) if order else rows,
            table,
            keys,
            preserve=preserve,
            partition_is_stable=partition_is_stable,
            newer_by=newer_by,
            touching=touching,
        )
        if merged:
            ledger.note_merged(spark, merged, stream, number)
        # Batches run in a session of their own; let the caller's see the new files.
        df.sparkSession.catalog.refreshTable(table)

    return (
        df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )


def dedupe_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per ``keys`` within ``delay`` of each other; the state stays bounded."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
