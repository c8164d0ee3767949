"""Order of rows within a table's partitions, so that file statistics skip by several columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.schemas import conform
from linewatch.sinks.tables import dynamic_overwrite, partition_columns

BITS = 6  # of each column in the order: 64 steps
SAMPLE = 10_000  # values that the steps are taken from; they shape files, never results


def _steps(df: DataFrame, column: str, bits: int) -> list:
    """Values that cut a sample of the column into 2**bits steps of about as many rows."""
    values = df.select(F.col(column).alias("v")).where("v IS NOT NULL")
    some = sorted(r.v for r in values.orderBy(F.rand(7)).limit(SAMPLE).collect())
    return [some[len(some) * i // (1 << bits)] for i in range(1, 1 << bits)] if some else []


def _step(column: Column, steps: Sequence, low: int = 0) -> Column:
    """The number of ``steps`` up to a value, by halving; 0 for an unknown one."""
    if not steps:
        return F.lit(low)
    half = len(steps) // 2
    return F.when(column >= F.lit(steps[half]), _step(column, steps[half + 1 :], low + half + 1)).otherwise(_step(column, steps[:half], low))


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A number whose bits are those of the columns' steps, in turns.

    Rows near in it are near in every column, so files cut along it are narrow in all of them.
    """
    key = F.lit(0).cast("bigint")
    for i, column in enumerate(columns):
        step = _step(F.col(column), _steps(df, column, bits))
        for bit in range(bits):
            place = bit * len(columns) + len(columns) - 1 - i
            key = key.bitwiseOR(F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1)).cast("bigint"), place))
    return key


def cluster_days(spark: SparkSession, table: str, by: Sequence[str], days: Iterable[date | None] | None = None, files: int | None = None) -> None:
    """Rewrite partitions of ``table`` with their rows along the curve of ``by``, in files of the advised size or ``files`` ranges.

    ``days`` picks values of the one partition column; all are rewritten without it. Rows stay the same. Small files of
    many merges become large ones on the way. The old files stay until the new ones are complete.
    """
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    parts = partition_columns(spark, table)
    if len(parts) != 1:
        raise ValueError(f"{table} must have one partition column, not {parts}")
    if days is not None:
        wanted = set(days)
        known = [d for d in wanted if d is not None]
        hit = F.col(parts[0]).isin(known) if known else F.lit(False)
        rows = rows.where(hit | F.col(parts[0]).isNull() if None in wanted else hit)
    keyed = rows.withColumn("_along", curve_key(rows, by))
    ranged = keyed.repartitionByRange(*([files] if files else []), parts[0], "_along").sortWithinPartitions(parts[0], "_along")
    with dynamic_overwrite(spark):
        conform(ranged, dict(spark.table(table).dtypes)).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
