"""Silver to gold: events with weather and forecast, reliability, alert context."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.functions.calendar import add_calendar, add_disruption_flags
from linewatch.operators.reliability import reliability_metrics
from linewatch.operators.temporal import asof_join
from linewatch.plans.silver import zoned_as
from linewatch.schemas import TABLES, conform

# How old an observation and how far ahead a forecast may be.
WEATHER_REACH = timedelta(minutes=30)
FORECAST_REACH = timedelta(hours=3)

# Dimensions of the daily metrics.
STATION_DIMS = ["current_station_name", "event_type"]
ROUTE_DIMS = ["route"]

_MEASURES = [
    "temperature", "feels_like", "weather_description", "humidity", "pressure",
    "wind_speed", "wind_gust", "wind_direction",
]


def _prefixed(weather: DataFrame, ts: str, ts_name: str, prefix: str) -> DataFrame:
    return weather.select(
        "city_name",
        F.col(ts).alias(ts_name),
        *[F.col(c).alias(prefix + c) for c in _MEASURES],
    )


def with_current_weather(trains: DataFrame, weather: DataFrame) -> DataFrame:
    """Each event with the newest observation of its city, calendar and flags.

    ``trains`` has one row per event, as silver has.
    """
    seen = _prefixed(weather, "weather_timestamp", "current_weather_timestamp", "current_")
    joined = asof_join(
        trains, seen, ["city_name"], "actual_timestamp", "current_weather_timestamp", WEATHER_REACH,
        right_unique=True, sub_second=False, instants=trains,
    )
    flagged = add_disruption_flags(add_calendar(joined, "actual_timestamp"))
    stamped = flagged.withColumns(
        {"event_date": F.to_date("actual_timestamp"), "ingest_timestamp": F.current_timestamp()}
    )
    return conform(stamped, zoned_as(trains, "actual_timestamp", TABLES["gold_weather_train"]))


def with_forecast(trains: DataFrame, forecast: DataFrame) -> DataFrame:
    """Each event of ``trains`` (one row per event) with the first forecast of its city from the event on."""
    events = trains.select("event_id", "train_id", "city_name", "actual_timestamp")
    ahead = _prefixed(forecast, "forecast_timestamp", "forecast_weather_timestamp", "forecast_")
    joined = asof_join(
        events, ahead, ["city_name"], "actual_timestamp", "forecast_weather_timestamp", FORECAST_REACH,
        direction="forward", right_unique=True, sub_second=False, instants=trains,
    )
    stamped = joined.withColumns(
        {"event_date": F.to_date("actual_timestamp"), "ingest_timestamp": F.current_timestamp()}
    )
    return conform(stamped, zoned_as(trains, "actual_timestamp", TABLES["gold_forecast_train"]))


def _stamped(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("ingest_timestamp", F.current_timestamp())


def station_reliability(trains: DataFrame, **options) -> DataFrame:
    return _stamped(reliability_metrics(trains, STATION_DIMS, **options))


def route_reliability(trains: DataFrame, **options) -> DataFrame:
    return _stamped(reliability_metrics(trains, ROUTE_DIMS, **options))
