"""Cut the rows of a key into time slices that one task can hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch_seconds
from ..schema import DAY_SECONDS

# A day of one key with more rows than this is cut further.
SLICE_ROWS = 1_000_000
# So many keys may be sent to all tasks.
MOST_KEYS = 1_000_000
# Stands for the second of a row without time: earlier than any other.
UNDATED = -(1 << 42)


def second_of(time: str) -> Column:
    """Whole epoch second of a time column; never null."""
    return F.coalesce(epoch_seconds(F.col(time)), F.lit(UNDATED))


def day_number(second: Column) -> Column:
    """Days since 1970 of an epoch second, rounded down."""
    return F.floor(second / DAY_SECONDS)


def large_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The keys of more than ``rows`` rows, in ``_large_key``; null is a key.

    The limit rises with the table beyond ``MOST_KEYS`` times ``rows`` rows, so that at most ``MOST_KEYS``
    keys are large and all tasks can be sent their list.
    """
    counts = df.groupBy(F.col(key).alias("_large_key")).count()
    least = df.agg(F.greatest(F.lit(rows), F.floor(F.count("*") / MOST_KEYS)).alias("_least"))
    return counts.join(F.broadcast(least), F.col("count") > F.col("_least")).select("_large_key")


def slice_starts(
    df: DataFrame, key: str, time: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The days of a key that need cutting, with the seconds at which their slices start.

    Rows are counted per day first. Only days of more than ``slice_rows`` rows are counted per
    second: there a slice ends where the running count passes a multiple of ``slice_rows``, so
    slices hold about as many rows however the rows crowd. Counts combine before the shuffle, and
    a day has at most 86,400 of them, so no group grows with the table. There is at most one row,
    and one start, for every ``slice_rows`` rows of the table; with a million, that is small enough
    to be sent to all tasks.
    """
    timed = df.select(key, second_of(time).alias("_second"))
    timed = timed.withColumn("_day", day_number(F.col("_second")))
    heavy = (
        timed.groupBy(F.col(key).alias("_heavy_key"), F.col("_day").alias("_heavy_day"))
        .count()
        .filter((F.col("count") > slice_rows) & (F.col("_heavy_day") > UNDATED // DAY_SECONDS))
        .drop("count")
    )
    same = F.col(key).eqNullSafe(F.col("_heavy_key")) & (F.col("_day") == F.col("_heavy_day"))
    along = Window.partitionBy(key, "_day").orderBy("_second")
    before = F.sum("count").over(along.rowsBetween(Window.unboundedPreceding, -1))
    return (
        timed.join(F.broadcast(heavy), same, "left_semi")
        .groupBy(key, "_day", "_second")
        .count()
        .withColumn("_part", F.floor(F.coalesce(before, F.lit(0)) / slice_rows))
        .groupBy(F.col(key).alias("_heavy_key"), F.col("_day").alias("_heavy_day"), "_part")
        .agg(F.min("_second").alias("_start"))
        .groupBy("_heavy_key", "_heavy_day")
        .agg(F.sort_array(F.collect_list("_start")).alias("_starts"))
    )


def with_slice(df: DataFrame, key: str, second: str, starts: DataFrame) -> DataFrame:
    """Add ``_slice``, the second in which the row's slice begins.

    A slice is one day of one key, or a part of a heavy day. A second is never cut, nor are a key's
    rows without time. The list of heavy days goes to all tasks (see ``slice_starts`` for its size).
    """
    day = day_number(F.col(second))
    start = F.element_at(F.filter("_starts", lambda s: s <= F.col(second)), -1)
    return (
        df.join(
            F.broadcast(starts),
            F.col(key).eqNullSafe(F.col("_heavy_key")) & (day == F.col("_heavy_day")),
            "left",
        )
        .withColumn("_slice", F.when(F.col("_starts").isNull(), day * DAY_SECONDS).otherwise(start))
        .drop("_heavy_key", "_heavy_day", "_starts")
    )
