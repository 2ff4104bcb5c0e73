"""Event-time expressions. Everything is UTC; ``timestamp_ms`` is Unix time in milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwatch.functions.numbers import whole_div

MS = "timestamp_ms"
MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def event_time(ms: str = MS) -> Column:
    return F.timestamp_millis(F.col(ms))


def event_date(ms: str = MS) -> Column:
    return F.to_date(event_time(ms))


def hour_of_day(ms: str = MS) -> Column:
    return F.pmod(whole_div(F.col(ms), F.lit(HOUR_MS)), F.lit(24)).cast("int")


def day_of_week(ms: str = MS) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(event_time(ms))


def is_night(hour: Column, first: int = 0, last: int = 5) -> Column:
    return hour.between(first, last)


def day_part(hour: Column) -> Column:
    return (F.when(hour.between(0, 5), "Night").when(hour.between(6, 11), "Morning")
            .when(hour.between(12, 17), "Afternoon").otherwise("Evening"))


def slot_start(width_ms: int, ms: str = MS) -> Column:
    """Start of the fixed slot a row falls in, in milliseconds."""
    return whole_div(F.col(ms), F.lit(width_ms)) * width_ms
