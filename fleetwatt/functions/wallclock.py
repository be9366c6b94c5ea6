"""Wall-clock arithmetic that never consults the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def ntz(value: str | datetime) -> Column:
    """Literal timestamp without a zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end as a double, exact to the microsecond."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


def whole_days_between(start: Column, end: Column) -> Column:
    """Completed 24-hour periods, not calendar-day boundaries."""
    return F.floor(seconds_between(start, end) / 86400.0).cast("int")


def month_start(date: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(date, "month")


def date_chunk(date: Column, days: int) -> Column:
    """Number of the fixed-length block of days a date falls in."""
    return F.floor(F.unix_date(date) / F.lit(days)).cast("int")
