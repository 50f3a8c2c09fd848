"""Time parsing, flooring and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_instant(value: Column) -> Column:
    """Timestamp from text, date or timestamp_ntz; null for text that is no timestamp."""
    return value.try_cast("timestamp")


def epoch_seconds(time: Column) -> Column:
    """Whole seconds since 1970, rounded down."""
    return F.unix_seconds(time.cast("timestamp"))


def european_day(day: Column) -> Column:
    """``21-03-2025``, the form of a history request."""
    return F.date_format(day, "dd-MM-yyyy")


def day_start_text(day: Column) -> Column:
    """``2025-03-21 00:00:00``, the form in snapshot files."""
    return F.date_format(day, "yyyy-MM-dd 00:00:00")


def compact_day(day: Column) -> Column:
    """``20250321``, the form in file names."""
    return F.date_format(day, "yyyyMMdd")


def output_name(day: Column, prefix: str = "snapshot") -> Column:
    """File name of a day's snapshot."""
    return F.format_string(f"{prefix}_%s.csv", compact_day(day))
