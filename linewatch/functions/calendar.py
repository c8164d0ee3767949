"""Calendar features of a timestamp and disruption flags of a delay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekend days (Sunday = 1), peak hours (whole hours, both ends
# included), delay limits in minutes and the statuses that carry a meaning.
WEEKEND_DAYS = (1, 7)
PEAK_HOURS = ((6, 9), (16, 19))
LATE_AFTER_MINUTES = 5
MAJOR_FROM_MINUTES = 15
LATE, CANCELLED = "LATE", "CANCELLED"


def is_peak(hour: Column) -> Column:
    first, *others = [hour.between(start, end) for start, end in PEAK_HOURS]
    for window in others:
        first = first | window
    return first


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    """Hour, day name, weekend and peak flags, month and year of ``ts``."""
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": F.date_format(ts, "EEEE"),
            "weekend_flag": F.dayofweek(ts).isin(*WEEKEND_DAYS),
            "is_peak_hour": is_peak(F.hour(ts)),
            "month": F.month(ts),
            "year": F.year(ts),
        }
    )


def add_disruption_flags(
    df: DataFrame,
    delay: str = "delay_minutes",
    status: str = "variation_status",
    late: int = LATE_AFTER_MINUTES,
    major: int = MAJOR_FROM_MINUTES,
) -> DataFrame:
    """Delayed, major-delay and cancelled flags; unknown inputs stay unknown."""
    running_late = F.col(status) == LATE
    return df.withColumns(
        {
            "is_delayed": (F.col(delay) > late) & running_late,
            "is_major_delay": (F.col(delay) >= major) & running_late,
            "is_cancelled": F.col(status) == CANCELLED,
        }
    )


def is_disrupted() -> Column:
    """Any of the three flags is true."""
    return F.col("is_delayed") | F.col("is_cancelled") | F.col("is_major_delay")
