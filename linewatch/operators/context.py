"""One wide row per disrupted event: weather, forecast and reliability around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.functions.calendar import is_disrupted
from linewatch.schemas import TABLES, conform

# Metric columns and the ending of their names in the alert table.
METRIC_NAMES = {
    "avg_delay": "average_delay",
    "scheduled_trains": "scheduled_trains",
    "on_time_trains": "on_time_trains",
    "late_trains": "late_trains",
    "reliability_index": "reliability_index",
}


def _metrics(df: DataFrame, keys: dict[str, str], prefix: str) -> DataFrame:
    names = {c: f"{prefix}_{n}" for c, n in METRIC_NAMES.items()}
    return df.select(
        *[F.col(c).alias(n) for c, n in keys.items()],
        *[F.col(c).alias(n) for c, n in names.items()],
    )


def alert_context(weather: DataFrame, forecast: DataFrame, route: DataFrame, station: DataFrame) -> DataFrame:
    """Disrupted events of ``weather`` with forecast and daily metrics, alert columns.

    Undisrupted events leave before the joins. Each joined side is unique per key,
    so no event is multiplied and a hot route or station can be split at run time.
    """
    events = weather.where(is_disrupted()).withColumn("event_date", F.to_date("actual_timestamp"))
    coming = forecast.select(
        F.col("event_id").alias("_f_event"),
        F.col("forecast_weather_timestamp").alias("forecast_timestamp"),
        *[c for c in forecast.columns if c.startswith("forecast_") and c != "forecast_weather_timestamp"],
    )
    by_route = _metrics(route, {"route": "_r_route", "date": "_r_date"}, "route")
    by_station = _metrics(
        station,
        {"current_station_name": "_s_name", "event_type": "_s_type", "date": "_s_date"},
        "station",
    )
    joined = (
        events.join(coming, events["event_id"] == coming["_f_event"], "left")
        .join(by_route, (F.col("route") == F.col("_r_route")) & (F.col("event_date") == F.col("_r_date")), "left")
        .join(
            by_station,
            (F.col("current_station_name") == F.col("_s_name"))
            & (F.col("event_type") == F.col("_s_type"))
            & (F.col("event_date") == F.col("_s_date")),
            "left",
        )
        .withColumnsRenamed({"current_station_name": "current_station", "next_station_name": "next_station"})
    )
    return conform(joined, {c: _kept_type(joined, c, t) for c, t in TABLES["alerts"].items()})


def _kept_type(df: DataFrame, col: str, wanted: str) -> str:
    """Timestamps keep the zone behaviour of the frame they come from."""
    have = dict(df.dtypes).get(col, wanted)
    return have if wanted == "timestamp" and have.startswith("timestamp") else wanted
