"""Pending alerts, the riders they concern and the alerts that came before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewatch.functions.calendar import is_disrupted
from linewatch.functions.keys import same_text
from linewatch.operators.clean import require

# Default look-back windows and the longest history of one alert.
PENDING_DAYS = 1
HISTORY_DAYS = 7
HISTORY_ROWS = 20

# Columns of a history row.
HISTORY_COLUMNS = [
    "event_id", "route", "current_station", "next_station", "event_type", "delay_minutes",
    "is_delayed", "is_major_delay", "is_cancelled", "event_date", "notified_at",
]

# Columns of a matched rider.
RIDER_COLUMNS = ["user_id", "email", "route", "station", "delay_threshold_minute"]


def pending(
    alerts: DataFrame,
    cursor: DataFrame,
    as_of: Column | None = None,
    lookback_days: int = PENDING_DAYS,
    large_cursor: bool = False,
) -> DataFrame:
    """Disrupted alerts of the last days whose ``event_id`` is not in ``cursor``.

    The date filter is a plain comparison on the partition column, so old
    partitions are not read, nor those of a cursor that has its alerts' ``event_date``. With ``large_cursor``
    only its rows of the alerts in question go on, by a semi join that Spark may turn into a
    Bloom filter on the cursor's scan (it puts none on an anti join).
    """
    today = F.current_date() if as_of is None else as_of
    in_reach = F.col("event_date") >= F.date_sub(today, lookback_days)
    recent = alerts.where(in_reach & is_disrupted())
    seen = (cursor.where(in_reach) if "event_date" in cursor.columns else cursor).select("event_id")
    if large_cursor:
        seen = seen.join(recent.select("event_id"), "event_id", "left_semi")
    return recent.join(seen, "event_id", "left_anti").select(alerts.columns)


def match_riders(
    alerts: DataFrame, prefs: DataFrame, carry: Sequence[str] = (), of_rider: Sequence[str] = ()
) -> DataFrame:
    """One row per alert and active rider whose route or station it touches.

    The rider must want delays of that length, or cancellations. ``event_id``
    comes first, then the rider's columns, then the alert columns to ``carry`` and further columns ``of_rider``.
    "Route or station" is split into two equi joins that cannot produce the same
    pair (the second leaves out pairs with equal routes), so neither a nested loop
    nor a distinct is needed.
    """
    disrupted = alerts.where(F.col("is_delayed") | F.col("is_cancelled")).select(
        "event_id",
        same_text(F.col("route")).alias("_a_route"),
        same_text(F.col("current_station")).alias("_a_station"),
        "delay_minutes",
        "is_delayed",
        "is_cancelled",
        *[F.col(c).alias(f"_carry_{c}") for c in carry],
    )
    riders = prefs.where(F.col("is_active") & (F.col("notify_delay") | F.col("notify_cancellation"))).select(
        *RIDER_COLUMNS,
        *[F.col(c).alias(f"_rider_{c}") for c in of_rider],
        same_text(F.col("route")).alias("_p_route"),
        same_text(F.col("station")).alias("_p_station"),
        "notify_delay",
        "notify_cancellation",
    )
    wanted = (
        F.col("is_delayed") & F.col("notify_delay") & (F.col("delay_threshold_minute") <= F.col("delay_minutes"))
    ) | (F.col("is_cancelled") & F.col("notify_cancellation"))
    one_route = F.col("_a_route") == F.col("_p_route")
    one_station = F.col("_a_station") == F.col("_p_station")
    other_route = ~F.coalesce(one_route, F.lit(False))
    out = ["event_id", *RIDER_COLUMNS, *[F.col(f"_carry_{c}").alias(c) for c in carry], *[F.col(f"_rider_{c}").alias(c) for c in of_rider]]
    on_route = disrupted.join(riders, one_route & wanted).select(*out)
    at_station = disrupted.join(riders, one_station & other_route & wanted).select(*out)
    return on_route.unionByName(at_station)


def _latest(df: DataFrame, group: list[str], limit: int) -> DataFrame:
    newest = Window.partitionBy(*group).orderBy(F.col("event_date").desc(), F.col("event_id").desc())
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= limit).drop("_rank")


def _place_history(
    places: DataFrame, sent: DataFrame, place: str, days: int, limit: int
) -> DataFrame:
    """The latest ``limit`` sent alerts per (``place``, day) of ``places``.

    A day can add at most ``limit`` rows to any answer, so each day is cut to
    that first; only then do its rows go to the later days that look back on it.
    """
    daily = _latest(sent.where(F.col(place).isNotNull()), [place, "event_date"], limit)
    reach = daily.withColumn(
        "_day", F.explode(F.sequence(F.col("event_date"), F.date_add("event_date", days)))
    ).withColumn("_place", F.col(place))
    wanted = (
        require(places, place, "event_date")
        .select(F.col(place).alias("_place"), F.col("event_date").alias("_day"))
        .distinct()
    )
    return _latest(reach.join(wanted, ["_place", "_day"]), ["_place", "_day"], limit)


def _history(alerts: DataFrame, log: DataFrame, days: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Distinct (route, station, day) of ``alerts`` and their history rows."""
    sent = log.where("notification_status = 'SENT'").select(HISTORY_COLUMNS)
    places = alerts.select("route", "current_station", "event_date").distinct()
    named = places.select(
        F.col("route").alias("_a_route"), F.col("current_station").alias("_a_station"), F.col("event_date").alias("_a_day")
    )
    day = F.col("_day") == F.col("_a_day")
    on_route = named.join(
        _place_history(places, sent, "route", days, limit), day & (F.col("_place") == F.col("_a_route"))
    )
    # A row of the same route either is in ``on_route`` or has ``limit`` newer
    # rows there, so leaving it out here changes no answer and avoids a distinct.
    at_station = named.join(
        _place_history(places, sent, "current_station", days, limit),
        day
        & (F.col("_place") == F.col("_a_station"))
        & ~F.coalesce(F.col("route") == F.col("_a_route"), F.lit(False)),
    )
    rows = on_route.unionByName(at_station).drop("_day", "_place")
    return named, _latest(rows, ["_a_route", "_a_station", "_a_day"], limit)


def _same_place(alerts: DataFrame, rows: DataFrame) -> Column:
    return (
        alerts["_at_route"].eqNullSafe(rows["_a_route"])
        & alerts["_at_station"].eqNullSafe(rows["_a_station"])
        & (alerts["_at_day"] == rows["_a_day"])
    )


def _placed(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        F.col("event_id").alias("alert_id"),
        F.col("route").alias("_at_route"),
        F.col("current_station").alias("_at_station"),
        F.col("event_date").alias("_at_day"),
    )


def alert_history(
    alerts: DataFrame, log: DataFrame, lookback_days: int = HISTORY_DAYS, limit: int = HISTORY_ROWS
) -> DataFrame:
    """Per alert (``alert_id``) the latest sent alerts of its route or station.

    At most ``limit`` rows each, newest day first and then by ``event_id``, from
    the alert's day and ``lookback_days`` before it. Work is done per distinct
    (route, station, day) and never pairs a place's alerts with each other.
    """
    _, rows = _history(alerts, log, lookback_days, limit)
    at = _placed(alerts)
    return at.join(rows, _same_place(at, rows)).select("alert_id", *HISTORY_COLUMNS)


def recent_alert_counts(
    alerts: DataFrame, log: DataFrame, lookback_days: int = HISTORY_DAYS, limit: int = HISTORY_ROWS
) -> DataFrame:
    """``event_id`` and the size of its :func:`alert_history`, 0 when empty."""
    _, rows = _history(alerts, log, lookback_days, limit)
    counts = rows.groupBy("_a_route", "_a_station", "_a_day").agg(F.count(F.lit(1)).alias("_n"))
    at = _placed(alerts)
    return at.join(counts, _same_place(at, counts), "left").select(
        F.col("alert_id").alias("event_id"), F.coalesce("_n", F.lit(0)).alias("recent_alerts")
    )
