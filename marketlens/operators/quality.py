"""Duplicates, nulls and range checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key in the given order.

    The rank filter becomes a window group limit on both sides of the shuffle, so each task
    sends one row per key however many copies the key has.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def drop_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, always the same one: the rest of the columns break the tie.

    Nulls sort last, so a complete copy is preferred to one with gaps.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return keep_first(df, keys, rest) if rest else df.dropDuplicates(list(keys))


def clean(
    df: DataFrame, keys: Sequence[str], required: Sequence[str], valid: Column
) -> DataFrame:
    """De-duplicate, then drop rows with a null in ``required``, then keep ``valid`` rows.

    The order matters: a key whose kept copy is bad disappears.
    """
    return drop_duplicate_keys(df, keys).na.drop(subset=list(required)).filter(valid)


def quality_report(df: DataFrame, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """One row: rows, rows beyond the first of their key, and nulls per required column.

    Nulls are counted within the groups that find the duplicates, so one shuffle of partial
    counts serves both.
    """
    nulls = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in required}
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[n.alias(name) for name, n in nulls.items()]
    )
    return grouped.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in nulls],
    )


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of their key."""
    return quality_report(df, keys, []).select("duplicate_rows")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: row count, nulls per column, and whether there is any null."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    any_null = F.coalesce(
        F.bool_or(F.greatest(*[F.col(c).isNull() for c in columns], F.lit(False))), F.lit(False)
    )
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts, any_null.alias("any_null"))


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame with a row count that fills while another action runs, and the count's handle."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
