"""Column names and types of every table, and projection of a frame onto them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.functions.casts import clean_cast

# Column names and types of the data model. Jobs that exchange
# tables with other systems rely on them, so they are listed as they are.
_ENVELOPE = {"event_key": "string", "kafka_timestamp": "timestamp", "raw_json": "string"}

_WEATHER_MEASURES = {
    "temperature": "double",
    "feels_like": "double",
    "weather_description": "string",
    "humidity": "int",
    "pressure": "int",
    "wind_speed": "double",
    "wind_gust": "double",
    "wind_direction": "int",
}

_METRICS = {
    "date": "date",
    "scheduled_trains": "bigint",
    "on_time_trains": "bigint",
    "late_trains": "bigint",
    "avg_delay": "double",
    "reliability_index": "double",
    "ingest_timestamp": "timestamp",
}

TABLES: dict[str, dict[str, str]] = {
    "rail_bronze": {
        **_ENVELOPE,
        "train_id": "string",
        "actual_timestamp": "timestamp",
        "loc_stanox": "string",
        "gbtt_timestamp": "timestamp",
        "planned_timestamp": "timestamp",
        "planned_event_type": "string",
        "event_type": "string",
        "event_source": "string",
        "correction_ind": "string",
        "offroute_ind": "string",
        "train_service_code": "string",
        "division_code": "string",
        "toc_id": "string",
        "timetable_variation": "string",
        "variation_status": "string",
        "next_report_stanox": "string",
        "next_report_run_time": "string",
        "train_terminated": "string",
        "header": "map<string,string>",
        "delay_monitoring_point": "string",
        "reporting_stanox": "string",
        "ingest_time": "timestamp",
    },
    "weather_bronze": {
        **_ENVELOPE,
        "city_name": "string",
        "weather_timestamp": "timestamp",
        "temperature": "double",
        "temp_min": "double",
        "temp_max": "double",
        "feels_like": "double",
        "weather_description": "string",
        "humidity": "int",
        "pressure": "int",
        "sea_level": "int",
        "ground_level": "int",
        "wind_speed": "double",
        "wind_direction": "int",
        "wind_gust": "double",
        "ingest_timestamp": "timestamp",
    },
    "forecast_bronze": {
        **_ENVELOPE,
        "city_name": "string",
        "forecast_timestamp": "timestamp",
        "forecast_time": "timestamp",
        "temperature": "double",
        "feels_like": "double",
        "humidity": "int",
        "pressure": "int",
        "wind_speed": "double",
        "wind_direction": "int",
        "wind_gust": "double",
        "weather_description": "string",
        "visibility": "int",
        "precipitation_probability": "double",
        "ingest_timestamp": "timestamp",
    },
    "rail_silver": {
        "event_id": "string",
        "train_id": "string",
        "train_service_code": "string",
        "city_name": "string",
        "route": "string",
        "event_type": "string",
        "variation_status": "string",
        "actual_timestamp": "timestamp",
        "planned_timestamp": "timestamp",
        "delay_minutes": "int",
        "loc_stanox": "string",
        "current_station_name": "string",
        "next_report_stanox": "string",
        "next_station_name": "string",
        "offroute_ind": "boolean",
        "correction_ind": "boolean",
        "train_terminated": "boolean",
        "delay_monitoring_point": "boolean",
        "event_date": "date",
        "event_hour": "int",
        "ingest_timestamp": "timestamp",
    },
    "weather_silver": {
        "event_id": "string",
        "city_name": "string",
        "weather_timestamp": "timestamp",
        **_WEATHER_MEASURES,
        "event_date": "date",
        "event_hour": "int",
        "ingest_timestamp": "timestamp",
    },
    "forecast_silver": {
        "event_id": "string",
        "city_name": "string",
        "forecast_timestamp": "timestamp",
        **_WEATHER_MEASURES,
        "visibility": "int",
        "event_date": "date",
        "event_hour": "int",
        "ingest_timestamp": "timestamp",
    },
    "gold_weather_train": {
        "event_id": "string",
        "train_id": "string",
        "route": "string",
        "current_station_name": "string",
        "next_station_name": "string",
        "city_name": "string",
        "event_type": "string",
        "offroute_ind": "boolean",
        "train_terminated": "boolean",
        "variation_status": "string",
        "delay_minutes": "int",
        "actual_timestamp": "timestamp",
        "planned_timestamp": "timestamp",
        "current_weather_timestamp": "timestamp",
        "current_temperature": "double",
        "current_feels_like": "double",
        "current_weather_description": "string",
        "current_humidity": "int",
        "current_pressure": "int",
        "current_wind_speed": "double",
        "current_wind_gust": "double",
        "current_wind_direction": "string",
        "hour_of_day": "int",
        "day_of_week": "string",
        "weekend_flag": "boolean",
        "is_peak_hour": "boolean",
        "month": "int",
        "year": "int",
        "is_delayed": "boolean",
        "is_major_delay": "boolean",
        "is_cancelled": "boolean",
        "event_date": "date",
        "ingest_timestamp": "timestamp",
    },
    "gold_forecast_train": {
        "event_id": "string",
        "train_id": "string",
        "city_name": "string",
        "forecast_weather_timestamp": "timestamp",
        "forecast_temperature": "double",
        "forecast_feels_like": "double",
        "forecast_humidity": "int",
        "forecast_pressure": "int",
        "forecast_wind_speed": "double",
        "forecast_wind_gust": "double",
        "forecast_wind_direction": "string",
        "forecast_weather_description": "string",
        "event_date": "date",
        "ingest_timestamp": "timestamp",
    },
    "gold_station_reliability": {
        "current_station_name": "string",
        "event_type": "string",
        **_METRICS,
    },
    "gold_route_reliability": {
        "route": "string",
        **_METRICS,
    },
    "alerts": {
        "event_id": "string",
        "train_id": "string",
        "route": "string",
        "current_station": "string",
        "next_station": "string",
        "city_name": "string",
        "event_type": "string",
        "event_date": "date",
        "variation_status": "string",
        "delay_minutes": "int",
        "offroute_ind": "boolean",
        "train_terminated": "boolean",
        "planned_timestamp": "timestamp",
        "actual_timestamp": "timestamp",
        "current_weather_timestamp": "timestamp",
        "current_temperature": "double",
        "current_feels_like": "double",
        "current_weather_description": "string",
        "current_pressure": "int",
        "current_humidity": "int",
        "current_wind_speed": "double",
        "current_wind_gust": "double",
        "current_wind_direction": "string",
        "forecast_timestamp": "timestamp",
        "forecast_temperature": "double",
        "forecast_feels_like": "double",
        "forecast_humidity": "int",
        "forecast_pressure": "int",
        "forecast_wind_speed": "double",
        "forecast_wind_gust": "double",
        "forecast_weather_description": "string",
        "forecast_wind_direction": "string",
        "hour_of_day": "int",
        "day_of_week": "string",
        "weekend_flag": "boolean",
        "is_peak_hour": "boolean",
        "is_cancelled": "boolean",
        "is_delayed": "boolean",
        "is_major_delay": "boolean",
        "route_average_delay": "double",
        "route_scheduled_trains": "bigint",
        "route_on_time_trains": "bigint",
        "route_late_trains": "bigint",
        "route_reliability_index": "double",
        "station_average_delay": "double",
        "station_scheduled_trains": "bigint",
        "station_on_time_trains": "bigint",
        "station_late_trains": "bigint",
        "station_reliability_index": "double",
        "ingest_timestamp": "timestamp",
        "notification_status": "string",
        "notified_at": "timestamp",
    },
    "delivery_log": {
        "notification_id": "string",
        "event_id": "string",
        "user_id": "string",
        "email": "string",
        "route": "string",
        "station": "string",
        "subject": "string",
        "message": "string",
        "delivery_status": "string",
        "created_at": "timestamp",
        "event_date": "date",
    },
    "dispatch_cursor": {
        "event_id": "string",
        "dispatched_at": "timestamp",
        "event_date": "date",
    },
    "dispatch_outbox": {
        "notification_id": "string",
        "event_id": "string",
        "user_id": "string",
        "email": "string",
        "subject": "string",
        "message": "string",
        "recorded_at": "timestamp",
        "event_date": "date",
    },
    # Every try to deliver a notification; the log holds the outcome of all tries.
    "delivery_attempts": {
        "notification_id": "string",
        "delivered": "boolean",
        "attempted_at": "timestamp",
        "event_date": "date",
    },
    # Days that merges are about to change, and what has dealt with them.
    "touched_days": {
        "source": "string",
        "event_date": "date",
        "batch": "string",
        "touched_at": "timestamp",
    },
    "consumed_days": {
        "consumer": "string",
        "batch": "string",
        "consumed_at": "timestamp",
    },
    # Micro-batches of streams that are merged.
    "merged_batches": {
        "stream": "string",
        "batch": "bigint",
        "merged_at": "timestamp",
    },
    "rider_preferences": {
        "user_id": "string",
        "email": "string",
        "route": "string",
        "station": "string",
        "delay_threshold_minute": "int",
        "notify_delay": "boolean",
        "notify_cancellation": "boolean",
        "is_active": "boolean",
    },
}

# How tables are laid out. Every keyed table is partitioned by day: a key never
# leaves its day, so an upsert rewrites the days of its batch and no others. By
# city, which every day's events share, each upsert would rewrite all history;
# city only orders the rows among the files of a day.
PARTITIONS = {
    "rail_silver": ["event_date"],
    "weather_silver": ["event_date"],
    "forecast_silver": ["event_date"],
    "gold_weather_train": ["event_date"],
    "gold_forecast_train": ["event_date"],
    "gold_station_reliability": ["date"],
    "gold_route_reliability": ["date"],
    "alerts": ["event_date"],
    # A notification belongs to its alert's day, so jobs read the days they look back on.
    "dispatch_cursor": ["event_date"],
    "dispatch_outbox": ["event_date"],
    "delivery_attempts": ["event_date"],
    "delivery_log": ["event_date"],
}

CLUSTERS = {
    "gold_weather_train": ["city_name"],
    "gold_forecast_train": ["city_name"],
}

# The columns that queries filter by within a day, from the widest down.
CURVES = {
    "rail_silver": ["city_name", "current_station_name", "event_hour"],
    "gold_weather_train": ["city_name", "current_station_name", "hour_of_day"],
    "alerts": ["city_name", "current_station", "hour_of_day"],
}

# What identifies a row.
KEYS = {
    "rail_silver": ["train_id", "actual_timestamp", "loc_stanox"],
    "weather_silver": ["event_id"],
    "forecast_silver": ["event_id"],
    "gold_weather_train": ["event_id"],
    "gold_forecast_train": ["event_id"],
    "alerts": ["event_id"],
    "delivery_log": ["notification_id"],
}


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Project ``df`` onto ``schema`` by name.

    Extra columns are dropped, missing ones become typed NULLs and others are
    cast; text that does not fit its target type becomes NULL instead of
    failing the job.
    """
    have = dict(df.dtypes)
    out = []
    for name, wanted in schema.items():
        if name not in have:
            out.append(F.lit(None).cast(wanted).alias(name))
        elif have[name] == wanted:
            out.append(F.col(name))
        else:
            out.append(clean_cast(F.col(name), have[name], wanted).alias(name))
    return df.select(*out)
