"""The two lookups as SQL table functions, for ad-hoc calls from SQL.

"Route or station" is put as two equality branches that can't give the same row twice,
as in :mod:`linewatch.operators.riders`, so a call over many alerts joins by key.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from linewatch.operators.riders import HISTORY_COLUMNS, HISTORY_ROWS, RIDER_COLUMNS
from linewatch.schemas import TABLES


def _either(columns: str, table: str, first: str, second: str, rest: str) -> str:
    """Rows for which ``rest`` and one of two equalities hold, the second without the first's rows."""
    return f"""
        SELECT {columns} FROM {table} WHERE {first} AND {rest}
        UNION ALL
        SELECT {columns} FROM {table} WHERE {second} AND NOT coalesce({first}, false) AND {rest}"""


def _returns(columns: list[str], schema: dict[str, str]) -> str:
    return ", ".join(f"{c} {schema[c].upper()}" for c in columns)


def create_matching_preferences(
    spark: SparkSession, prefs: str, name: str = "get_matching_preferences", temporary: bool = False
) -> None:
    """``name(route, station, delay, is_delayed, is_cancelled)``: riders of one alert."""
    cancelled = "p_is_cancelled AND notify_cancellation"
    late = "p_is_delayed AND notify_delay AND delay_threshold_minute <= p_delay_minutes"
    body = _either(
        ", ".join(RIDER_COLUMNS), prefs,
        "lower(trim(route)) = lower(trim(p_route))", "lower(trim(station)) = lower(trim(p_station))",
        f"is_active AND (({cancelled}) OR ({late}))",
    )
    spark.sql(f"""
        CREATE OR REPLACE {"TEMPORARY " if temporary else ""}FUNCTION {name}(
            p_route STRING, p_station STRING, p_delay_minutes INT, p_is_delayed BOOLEAN, p_is_cancelled BOOLEAN)
        RETURNS TABLE ({_returns(RIDER_COLUMNS, TABLES["rider_preferences"])})
        RETURN {body}""")


def create_alert_history(
    spark: SparkSession, alerts: str, name: str = "get_alert_history", temporary: bool = False
) -> None:
    """``name(route, station, day, days)``: latest sent alerts of a route or station."""
    columns = ", ".join(HISTORY_COLUMNS)
    reach = "notification_status = 'SENT' AND event_date BETWEEN date_sub(p_event_date, p_lookback_days) AND p_event_date"
    found = _either(columns, alerts, "route = p_route", "current_station = p_station", reach)
    spark.sql(f"""
        CREATE OR REPLACE {"TEMPORARY " if temporary else ""}FUNCTION {name}(
            p_route STRING, p_station STRING, p_event_date DATE, p_lookback_days INT)
        RETURNS TABLE ({_returns(HISTORY_COLUMNS, TABLES["alerts"])})
        RETURN
            SELECT {columns}
            FROM (SELECT *, row_number() OVER (ORDER BY event_date DESC, event_id DESC) AS place FROM ({found}))
            WHERE place <= {HISTORY_ROWS}""")
