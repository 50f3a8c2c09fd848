"""Column expressions: change, segment, time, CSV line and JSON field helpers."""

from .changes import change_or_zero, is_anomaly, is_normal, percent_change
from .fields import field, field_or
from .lines import columns_to_line, line_to_struct
from .segments import segment_of
from .times import (
    compact_day,
    day_start_text,
    epoch_seconds,
    european_day,
    output_name,
    to_instant,
)

__all__ = [
    "change_or_zero",
    "columns_to_line",
    "compact_day",
    "day_start_text",
    "epoch_seconds",
    "european_day",
    "field",
    "field_or",
    "is_anomaly",
    "is_normal",
    "line_to_struct",
    "output_name",
    "percent_change",
    "segment_of",
    "to_instant",
]
