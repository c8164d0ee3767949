"""Station, route and rider reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.schemas import TABLES, conform

# File names and columns of the two lookup files.
STATION_FILE, STATION_COLUMNS = "station_codes.csv", ["STANOX_NO", "FULL_NAME", "Route_Description"]
ROUTE_FILE, ROUTE_COLUMNS = "mapping.csv", ["Route", "City"]

# The table and columns of rider preferences in the source database.
RIDER_TABLE = "user_preferences"


def _csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    # Without inference every column is text (codes keep their zeros) and is found
    # by its header, whatever the order in the file.
    return spark.read.option("header", True).csv(path).select(*columns)


def read_stations(spark: SparkSession, folder: str) -> DataFrame:
    return _csv(spark, f"{folder.rstrip('/')}/{STATION_FILE}", STATION_COLUMNS)


def read_routes(spark: SparkSession, folder: str) -> DataFrame:
    return _csv(spark, f"{folder.rstrip('/')}/{ROUTE_FILE}", ROUTE_COLUMNS)


def rider_preferences(rows: DataFrame) -> DataFrame:
    """Preference columns by name, the user id as text."""
    return conform(rows.withColumn("user_id", F.col("user_id").cast("string")), TABLES["rider_preferences"])


def rider_query(table: str = RIDER_TABLE) -> str:
    return f"SELECT {', '.join(TABLES['rider_preferences'])} FROM {table}"


def read_riders_jdbc(spark: SparkSession, url: str, table: str = RIDER_TABLE, **options: str) -> DataFrame:
    """Preferences from a database.

    For large tables name a number, date or timestamp column as ``partitionColumn``, and ``numPartitions``, so that
    tasks share the read. Its bounds are asked for, by one aggregate that the database answers, unless they are given
    (``lowerBound``, ``upperBound``). Without a column one task reads all.
    """
    reader = spark.read.format("jdbc").option("url", url)
    column = options.get("partitionColumn")
    if column and "lowerBound" not in options:
        plain = {k: v for k, v in options.items() if k not in ("partitionColumn", "numPartitions")}
        bounds = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) b"
        low, high = spark.read.format("jdbc").option("url", url).option("dbtable", bounds).options(**plain).load().first()
        known = {"lowerBound": str(low), "upperBound": str(high)} if low is not None else {}
        options = {**options, **known} if known else plain  # an empty table has no bounds and needs no parts
    return rider_preferences(reader.option("dbtable", f"({rider_query(table)}) p").options(**options).load())
