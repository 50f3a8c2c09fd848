"""Percent change and the anomaly tests on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ANOMALY_PERCENT


def percent_change(current: Column, previous: Column) -> Column:
    """Change from ``previous`` to ``current`` in percent; null where ``previous`` is 0 or null."""
    return F.try_divide(current - previous, previous) * 100


def change_or_zero(current: Column, previous: Column) -> Column:
    """As ``percent_change``, but 0.0 for a row without predecessor."""
    return F.when(previous.isNull(), F.lit(0.0)).otherwise(percent_change(current, previous))


def is_anomaly(change: Column, threshold: float = ANOMALY_PERCENT) -> Column:
    """True from the threshold on, in either direction; null for a null change."""
    return F.abs(change) >= threshold


def is_normal(change: Column, threshold: float = ANOMALY_PERCENT) -> Column:
    """True below the threshold; null for a null change, so such a row is on neither side."""
    return F.abs(change) < threshold
