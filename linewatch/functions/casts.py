"""Casts for text from JSON and CSV: a value that does not fit becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds from year 1 to year 9999; anything outside is not a usable instant.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def as_bool(c: Column) -> Column:
    return F.trim(c).try_cast("boolean")


def as_int(c: Column) -> Column:
    """Whole part of a number in text: ``'1013.5'`` gives 1013."""
    return c.try_cast("double").try_cast("int")


def as_double(c: Column) -> Column:
    return c.try_cast("double")


def clean_cast(c: Column, have: str, wanted: str) -> Column:
    """Cast from type ``have`` to ``wanted`` without failing on dirty text."""
    if have == "string" and wanted == "boolean":
        return as_bool(c)
    if have == "string" and wanted == "int":
        return as_int(c)
    if wanted.startswith("map<") or have.startswith("map<"):
        return c.cast(wanted)
    return c.try_cast(wanted)


def _instant(seconds: Column) -> Column:
    return F.timestamp_seconds(F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds))


def from_epoch_seconds(c: Column) -> Column:
    """Epoch seconds in text to an instant."""
    return _instant(c.try_cast("bigint"))


def from_epoch_millis(c: Column) -> Column:
    """Epoch milliseconds in text to an instant of whole seconds."""
    return _instant(F.call_function("div", c.try_cast("bigint"), F.lit(1000)))


def wall_clock(c: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text in ``pattern`` to a timestamp."""
    return F.try_to_timestamp(c, F.lit(pattern))


def second_count(c: Column, dtype: str) -> Column:
    """Whole seconds on a straight time line.

    Instants count from the epoch; zone-less timestamps count by their own wall
    clock, so the session zone and its clock changes play no part.
    """
    if dtype == "timestamp_ntz":
        day = F.unix_date(F.to_date(c)).cast("bigint") * 86400
        return day + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.unix_seconds(c)
