"""Lines to typed rows, and the anomaly filter. Both work on streams and on batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_anomaly, line_to_struct, to_instant
from ..schema import ANOMALY_PERCENT, CHANGE_1, CORRUPT, SNAPSHOT_COLUMNS, SNAPSHOT_KEY, TIME


def parse_stream(lines: DataFrame, value: str = "value") -> DataFrame:
    """CSV lines (text or bytes) to the snapshot columns plus ``_corrupt_record``.

    A bad number or date becomes null and does not stop the stream.
    """
    return (
        lines.select(line_to_struct(F.col(value)).alias("data"))
        .select("data.*")
        .withColumn(TIME, to_instant(F.col(TIME)))
    )


def stream_anomalies(lines: DataFrame, threshold: float = ANOMALY_PERCENT) -> DataFrame:
    """Rows whose change reaches the threshold. Keeps no state, so it needs no watermark."""
    rows = parse_stream(lines).select(*SNAPSHOT_COLUMNS)
    return rows.filter(is_anomaly(F.col(CHANGE_1), threshold))


def without_repeats(
    rows: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY, within: str = "1 hour", time: str = TIME
) -> DataFrame:
    """Drop rows that a random spooler sent before, also before a restart.

    A key is remembered until the latest time seen is more than ``within`` past its own, so state is
    bounded by the keys of that span. A row that comes later than that is dropped, repeat or not.
    """
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))
