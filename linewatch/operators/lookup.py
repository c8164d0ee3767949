"""Small reference tables joined onto events, under one or several roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.functions.keys import plain_code
from linewatch.operators.clean import dedupe


def unique_dimension(dim: DataFrame, key: str) -> DataFrame:
    """One row per known ``key``, so that a lookup never multiplies events."""
    others = [F.col(c).asc_nulls_last() for c in dim.columns if c != key]
    return dedupe(dim.where(F.col(key).isNotNull()), [key], others or [F.col(key)])


def lookup(
    df: DataFrame,
    dim: DataFrame,
    code: str,
    key: str,
    take: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Join ``dim`` on ``df.code = dim.key`` and add ``take`` (new name: dim column).

    Codes are compared without blanks and leading zeros. The same ``dim`` may be
    used again under another role by passing other names in ``take``. Whether it
    is broadcast is left to Spark, which checks its size against
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles.
    """
    keyed = dim.select(plain_code(F.col(key)).alias("_code"), *[F.col(c).alias(n) for n, c in take.items()])
    keyed = unique_dimension(keyed, "_code")
    probe = df.withColumn("_probe", plain_code(F.col(code)))
    return probe.join(keyed, probe["_probe"] == keyed["_code"], how).drop("_probe", "_code")


def station_routes(stations: DataFrame, routes: DataFrame) -> DataFrame:
    """Stations whose route belongs to a known city: ``code, name, route, city``.

    The two reference tables meet before any event is touched, so events need one
    join to learn station, route and city.
    """
    places = stations.select(
        F.col("STANOX_NO").alias("code"),
        F.col("FULL_NAME").alias("name"),
        F.col("Route_Description").alias("route"),
    )
    cities = unique_dimension(routes.select(F.col("Route").alias("route"), F.col("City").alias("city")), "route")
    coded = unique_dimension(places.withColumn("code", plain_code(F.col("code"))), "code")
    return coded.join(cities, "route").select("code", "name", "route", "city")
