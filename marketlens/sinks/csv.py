"""CSV outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compact_day
from ..schema import TIME


def write_daily(df: DataFrame, path: str, time: Column | str = TIME) -> None:
    """Overwrite with one folder of headed CSV per day, ``day=20250321``."""
    day = F.col(time) if isinstance(time, str) else time
    (
        df.withColumn("day", compact_day(day))
        .hint("rebalance", "day")
        .write.mode("overwrite")
        .partitionBy("day")
        .option("header", True)
        .csv(path)
    )


def write_combined(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite with headerless CSV. ``single_file`` writes through one task: small tables only."""
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").option("header", False).csv(path)


def append_lines(df: DataFrame, path: str) -> None:
    """Append headerless CSV files."""
    df.write.mode("append").option("header", False).csv(path)
