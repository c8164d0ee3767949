"""Texts for an alert: the ``key=value`` summary, subject line and message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.functions.weather import is_disruptive, trend

# The alert fields a summary lists, in order.
SUMMARY_FIELDS = [
    "event_id", "train_id", "route", "current_station", "next_station", "city_name",
    "event_type", "event_date", "delay_minutes", "is_delayed", "is_major_delay",
    "is_cancelled", "offroute_ind", "train_terminated",
    "current_temperature", "current_feels_like", "current_wind_speed",
    "current_wind_gust", "current_wind_direction", "current_humidity",
    "current_pressure", "current_weather_description",
    "forecast_temperature", "forecast_feels_like", "forecast_wind_speed",
    "forecast_wind_gust", "forecast_wind_direction", "forecast_humidity",
    "forecast_pressure", "forecast_weather_description",
    "route_reliability_index", "station_reliability_index",
]

# How many earlier notified alerts on the route or station make a pattern.
PATTERN_FROM = 2


def prompt_text(cols: Sequence[str]) -> Column:
    """``a=1 b=x``, fields that are NULL left out."""
    return F.concat_ws(" ", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in cols])


def _place(c: str, fallback: str) -> Column:
    return F.coalesce(F.col(c), F.lit(fallback))


# The wording of subjects and messages below.
def subject_line() -> Column:
    station, route = _place("current_station", "your station"), _place("route", "your")
    minutes = F.col("delay_minutes").cast("string")
    return (
        F.when(F.col("is_cancelled"), F.concat(F.lit("Cancellation on "), route, F.lit(" route at "), station))
        .when(F.col("is_major_delay"), F.concat(F.lit("Major delay at "), station, F.lit(": "), minutes, F.lit(" min")))
        .otherwise(F.concat(F.lit("Delay at "), station, F.lit(": "), minutes, F.lit(" min")))
    )


def _what_happened() -> Column:
    station, route = _place("current_station", "your station"), _place("route", "your")
    minutes = F.col("delay_minutes").cast("string")
    late = F.concat(
        F.lit("The train on the "), route, F.lit(" route "),
        F.when(F.col("is_major_delay"), "had a major delay of ").otherwise("was delayed by "),
        minutes, F.lit(" minutes at "), station, F.lit("."),
    )
    cancelled = F.concat(
        F.lit("Your train on the "), route, F.lit(" route via "), station, F.lit(" has been cancelled."),
    )
    return F.when(F.col("is_cancelled"), cancelled).otherwise(late)


def _weather_sentences() -> Column:
    now, later = F.col("current_weather_description"), F.col("forecast_weather_description")
    heading = trend(now, later)
    link = F.concat(F.lit("This may be linked to "), F.lower(now), F.lit(" in the area"))
    outlook = (
        F.when(heading == "EASE", "; conditions are expected to ease.")
        .when(heading == "WORSEN", "; conditions are expected to worsen, so plan for possible further delays.")
        .when(heading == "PERSIST", "; similar conditions are expected to continue.")
        .otherwise(".")
    )
    coming = F.concat(F.lit("The cause is unclear, but "), F.lower(later), F.lit(" is forecast and conditions are expected to worsen."))
    return (
        F.when(is_disruptive(now), F.concat(link, outlook))
        .when(is_disruptive(later) & (heading == "WORSEN"), coming)
        .otherwise("The cause is unclear.")
    )


def message_text() -> Column:
    """What happened, then a plausible weather link, then a recent pattern.

    Weather is only named, never measured: no figures but the delay appear.
    """
    pattern = F.when(
        F.coalesce(F.col("recent_alerts"), F.lit(0)) >= PATTERN_FROM,
        "There have been several disruptions on this route or station recently.",
    )
    return F.concat_ws(" ", _what_happened(), _weather_sentences(), pattern)


def add_draft(df: DataFrame) -> DataFrame:
    """Add ``subject`` and ``message``; needs the alert columns and ``recent_alerts``."""
    return df.withColumns({"subject": subject_line(), "message": message_text()})
