"""Not-null filter and one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Keep the rows in which every one of ``cols`` is known.

    Written as plain ``IS NOT NULL`` tests, which reach the parquet scan.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order``. NULL keys count as equal.

    Spark cuts every map task's rows to one per key before the shuffle
    (``WindowGroupLimit``), so a key with a third of all rows costs the reducer
    only one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def newest(*cols: str) -> list[Column]:
    """Order for :func:`dedupe`: latest first, column after column."""
    return [F.col(c).desc_nulls_last() for c in cols]
