"""Alerts to notifications, as one plan without driver loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from linewatch.operators.delivery import cursor_days, cursor_rows, draft_notifications, outbox_rows
from linewatch.operators.riders import HISTORY_DAYS, PENDING_DAYS, pending, recent_alert_counts


def notify(
    waiting: DataFrame,
    prefs: DataFrame,
    log: DataFrame,
    history_days: int = HISTORY_DAYS,
    at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Outbox rows and cursor rows of the ``waiting`` alerts; ``log`` holds sent ones."""
    recent = recent_alert_counts(waiting, log, history_days)
    drafts = draft_notifications(waiting, prefs, recent)
    return outbox_rows(drafts, at), cursor_rows(waiting, at)


def notify_by_day(
    waiting: DataFrame, prefs: DataFrame, log: DataFrame, history_days: int = HISTORY_DAYS, at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`notify`, each row with its alert's ``event_date``."""
    recent = recent_alert_counts(waiting, log, history_days)
    drafts = draft_notifications(waiting, prefs, recent, carry=["event_date"])
    return outbox_rows(drafts, at), cursor_days(waiting, at)


def dispatch(
    alerts: DataFrame,
    prefs: DataFrame,
    cursor: DataFrame,
    as_of: Column | None = None,
    lookback_days: int = PENDING_DAYS,
    history_days: int = HISTORY_DAYS,
    at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Outbox rows and cursor rows of the pending alerts.

    Write the outbox before the cursor: if a run breaks in between, the next one
    drafts the same notifications under the same ids.
    """
    return notify(pending(alerts, cursor, as_of, lookback_days), prefs, alerts, history_days, at)
