"""Declared tables and the ways of writing them.

Parquet tables know neither MERGE nor UPDATE, so :func:`merge_table` rewrites the
partitions a batch touches. Tables of a format that supports MERGE take
:func:`merge_native`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.operators.upsert import upsert
from linewatch.schemas import conform
from linewatch.session import drop_folder, ensure_checkpoint_dir, staging_folder


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(
    spark: SparkSession, table: str, schema: Mapping[str, str], partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    columns = ", ".join(f"`{c}` {t}" for c, t in schema.items())
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{layout}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one table partition together, a hot one split into several files."""
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append_table(df: DataFrame, table: str) -> None:
    """Append, columns matched by name."""
    target = df.sparkSession.table(table)
    conform(df, dict(target.dtypes)).write.mode("append").insertInto(table)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild a table with the schema of ``df``. ``df`` must not read that table."""
    writer = _balanced(df, partition_by).write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def replace_partitions(df: DataFrame, table: str, cluster_by: Sequence[str] = ()) -> None:
    """Overwrite only the partitions that ``df`` has rows for; ``df`` may read them, as they stay until the write is done.

    Rows with equal ``cluster_by`` share files, so filters on it skip the others.
    """
    target = df.sparkSession.table(table)
    parts = partition_columns(df.sparkSession, table)
    rows = _balanced(conform(df, dict(target.dtypes)), [*parts, *cluster_by])
    with dynamic_overwrite(df.sparkSession):
        rows.write.mode("overwrite").insertInto(table)


def _literal(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def merge_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    preserve: Sequence[str] = (),
    partition_is_stable: bool = True,
    cluster_by: Sequence[str] = (),
    newer_by: str | None = None,
    touching: Callable[[list[tuple]], None] | None = None,
) -> None:
    """Upsert ``source`` into a parquet table, rewriting only touched partitions.

    ``partition_is_stable`` says that a key never changes its partition. If it
    may, the partitions that hold a source key now are rewritten as well. ``touching`` is told the
    values of the partitions before they change.

    Two writes a merge: the source, which is read several times, is staged once, and
    the merged partitions go to their table. There they take the place of the old files only when
    the job is done, so a lost executor only repeats tasks. A table without partitions is
    overwritten as a whole, and what it will hold is staged before.
    """
    spark = source.sparkSession
    ensure_checkpoint_dir(spark)
    spark.catalog.refreshTable(table)
    target = spark.table(table)
    source = conform(source, dict(target.dtypes))
    parts = partition_columns(spark, table)
    folder = staging_folder(spark)

    def settled(df: DataFrame) -> DataFrame:
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    if not parts:
        merged = settled(upsert(target, source, keys, preserve=preserve, newer_by=newer_by))
        _balanced(merged, ()).write.mode("overwrite").insertInto(table)
        drop_folder(spark, folder)
        return

    source = settled(source)
    touched = source.select(*parts).distinct()
    if not partition_is_stable:
        marks = source.select(*keys)
        match = reduce(lambda a, b: a & b, [target[k].eqNullSafe(marks[k]) for k in keys])
        touched = touched.unionByName(target.join(marks, match, "left_semi").select(*parts).distinct()).distinct()
    # Partition values only: as many as the catalog lists for this table.
    values = [tuple(r) for r in touched.collect()]
    if values:
        if touching:
            touching(values)
        # Column by column: with several this may take in more partitions than touched,
        # which are then rewritten as they are.
        inside = F.lit(True)
        for i, c in enumerate(parts):
            known = [v for v in {row[i] for row in values} if v is not None]
            hit = target[c].isin(known)
            inside = inside & ((hit | target[c].isNull()) if any(row[i] is None for row in values) else hit)
        merged = upsert(target.where(inside), source, keys, preserve=preserve, newer_by=newer_by)
        left = values if partition_is_stable else {tuple(r) for r in merged.select(*parts).distinct().collect()}
        replace_partitions(merged, table, cluster_by)
        for gone in [v for v in values if v not in left and None not in v]:
            spec = ", ".join(f"{c} = {_literal(x)}" for c, x in zip(parts, gone))
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    drop_folder(spark, folder)


def merge_native(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    preserve: Sequence[str] = (),
    newer_by: str | None = None,
    touching: Callable[[list[tuple]], None] | None = None,
    **layout: object,
) -> None:
    """The same upsert through MERGE, for table formats that support it.

    The source is read more than once where ``touching`` asks for its days, so it should be settled then. ``layout``
    takes the options of :func:`merge_table` that only concern files.
    """
    target = source.sparkSession.table(table)
    staged = conform(source, dict(target.dtypes))
    parts = partition_columns(source.sparkSession, table) if touching else []
    if parts and (values := [tuple(r) for r in staged.select(*parts).distinct().collect()]):
        touching(values)
    staged = staged.alias("s")
    match = reduce(lambda a, b: a & b, [F.col(f"{table}.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    changes = {c: F.col(f"s.{c}") for c in target.columns if c not in preserve}
    newer = None
    if newer_by:
        held, new = F.col(f"{table}.{newer_by}"), F.col(f"s.{newer_by}")
        newer = held.isNull() | F.coalesce(new >= held, F.lit(False))
    staged.mergeInto(table, match).whenMatched(newer).update(changes).whenNotMatched().insertAll().merge()
