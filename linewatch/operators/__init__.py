"""Relational operators, each a lazy ``DataFrame -> DataFrame`` function."""

from linewatch.operators.clean import dedupe, newest, require
from linewatch.operators.context import alert_context
from linewatch.operators.delivery import (
    cursor_rows, delivery_log, delivery_summary, draft_notifications, extract_drafts, outbox_rows, raise_on_failure,
)
from linewatch.operators.lookup import lookup, station_routes, unique_dimension
from linewatch.operators.reliability import reliability_metrics, train_daily_status
from linewatch.operators.riders import alert_history, match_riders, pending, recent_alert_counts
from linewatch.operators.temporal import asof_join, interval_join
from linewatch.operators.upsert import mark_notified, upsert
from linewatch.operators.windows import geo_enrich, tumbling_counts

__all__ = [
    "alert_context", "alert_history", "asof_join", "cursor_rows", "dedupe", "delivery_log", "delivery_summary",
    "draft_notifications", "extract_drafts", "geo_enrich", "interval_join", "lookup", "mark_notified", "match_riders",
    "newest", "outbox_rows", "pending", "raise_on_failure", "recent_alert_counts", "reliability_metrics", "require",
    "station_routes", "train_daily_status", "tumbling_counts", "unique_dimension", "upsert",
]
