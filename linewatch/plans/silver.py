"""Bronze to silver: one clean row per natural key, with keys, places and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.functions.keys import plain_code, unique_key
from linewatch.operators.clean import dedupe, newest, require
from linewatch.operators.lookup import lookup, station_routes
from linewatch.schemas import KEYS, TABLES, conform

def _latest_message(bronze: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One message per ``keys``: the last one the broker received.

    Messages of the same moment are told apart by their content, so that runs
    agree. The raw text is not part of it and is neither read nor shuffled.
    """
    rows = require(bronze, *[k for k in keys if k != "actual_timestamp"]).select(
        "kafka_timestamp", "event_key", *columns, F.xxhash64(*columns).alias("_content")
    )
    return dedupe(rows, keys, newest("kafka_timestamp", "event_key", "_content")).drop("_content")


def zoned_as(df: DataFrame, ts: str, schema: dict[str, str]) -> dict[str, str]:
    """``schema`` with timestamps as zoned or zone-less as ``df`` has them."""
    have = dict(df.dtypes)[ts]
    return {c: have if t == "timestamp" and c != "ingest_timestamp" else t for c, t in schema.items()}


# Movement columns that leave silver's input, with their types.
MOVEMENT_TYPES = {
    "train_id": "string",
    "train_service_code": "string",
    "actual_timestamp": "timestamp",
    "planned_timestamp": "timestamp",
    "event_type": "string",
    "planned_event_type": "string",
    "variation_status": "string",
    "event_source": "string",
    "loc_stanox": "string",
    "next_report_stanox": "string",
    "next_report_run_time": "int",
    "toc_id": "int",
    "division_code": "string",
    "offroute_ind": "boolean",
    "train_terminated": "boolean",
    "delay_monitoring_point": "boolean",
    "correction_ind": "boolean",
    "timetable_variation": "int",
}


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("event_id", unique_key(keys, dict(df.dtypes)))


def _at_stations(bronze: DataFrame, here: DataFrame) -> DataFrame:
    """Messages from stations that ``here`` knows; the others need not be sorted out later."""
    codes = here.select(plain_code(F.col("code")).alias("_code")).distinct()
    return bronze.join(codes, plain_code(F.col("loc_stanox")) == F.col("_code"), "left_semi")


def clean_movements(bronze: DataFrame, ordered: bool = False) -> DataFrame:
    """Typed movements with known train and location, one per natural key."""
    kept = _latest_message(bronze, KEYS["rail_silver"], list(MOVEMENT_TYPES))
    typed = conform(kept, zoned_as(bronze, "actual_timestamp", MOVEMENT_TYPES | (ORDER if ordered else {})))
    return typed.withColumnRenamed("timetable_variation", "delay_minutes")


# The broker's time, by which later runs tell newer messages from older ones.
ORDER_COLUMN = "kafka_timestamp"
ORDER = {ORDER_COLUMN: "timestamp"}


def train_events(bronze: DataFrame, stations: DataFrame, routes: DataFrame, ordered: bool = False) -> DataFrame:
    """Rail silver. Movements at stations without a known route and city are left out.

    They leave before messages are sorted for the last one per key: the station is part of the key, so the order
    of the two steps changes no row. ``ordered`` keeps the broker's time as a last column.
    """
    here = station_routes(stations, routes)
    moves = clean_movements(_at_stations(bronze, here), ordered)
    placed = lookup(
        moves, here, "loc_stanox", "code",
        {"current_station_name": "name", "route": "route", "city_name": "city"}, "inner",
    )
    towards = lookup(placed, stations, "next_report_stanox", "STANOX_NO", {"next_station_name": "FULL_NAME"})
    keyed = _keyed(towards, KEYS["rail_silver"]).withColumns(
        {
            "event_date": F.to_date("actual_timestamp"),
            "event_hour": F.hour("actual_timestamp"),
            "ingest_timestamp": F.current_timestamp(),
        }
    )
    schema = TABLES["rail_silver"] | (ORDER if ordered else {})
    return conform(keyed, zoned_as(bronze, "actual_timestamp", schema))


def _weather(bronze: DataFrame, ts: str, schema: dict[str, str]) -> DataFrame:
    keys = ["city_name", ts]
    kept = _latest_message(bronze, keys, [c for c in schema if c in bronze.columns and c not in ORDER])
    keyed = _keyed(kept, keys).withColumns({"event_date": F.to_date(ts), "event_hour": F.hour(ts)})
    return conform(keyed, zoned_as(bronze, ts, schema))


def weather_current(bronze: DataFrame, ordered: bool = False) -> DataFrame:
    """Observations per city and time; the bronze ingest time is kept."""
    return _weather(bronze, "weather_timestamp", TABLES["weather_silver"] | (ORDER if ordered else {}))


def weather_forecast(bronze: DataFrame, ordered: bool = False) -> DataFrame:
    """Forecasts per city and time, stamped anew."""
    stamped = bronze.withColumn("ingest_timestamp", F.current_timestamp())
    return _weather(stamped, "forecast_timestamp", TABLES["forecast_silver"] | (ORDER if ordered else {}))
