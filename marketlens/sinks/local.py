"""Small results on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def first_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any n rows, or the first n of a sorted frame."""
    return df.limit(n)


def show_first(df: DataFrame, n: int = 10) -> None:
    """Print n rows in full."""
    df.show(n, truncate=False)


def to_local(df: DataFrame, max_rows: int = 1_000_000) -> pd.DataFrame:
    """A result as a pandas frame; an error, not a part of it, if it has more than ``max_rows``."""
    local = df.limit(max_rows + 1).toPandas()
    if len(local) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate or write to a table instead")
    return local


def scalar_text(df: DataFrame, label: str, digits: int = 2) -> str:
    """``label: value`` of a one-row, one-column frame."""
    value = df.first()[0]
    return f"{label}: {'null' if value is None else format(value, f'.{digits}f')}"
