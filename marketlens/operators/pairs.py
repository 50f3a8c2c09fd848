"""Two slices of one table side by side, and correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A block of one side's rows at one time.
BLOCK_ROWS = 10_000


def pair_on_time(
    df: DataFrame, key: str, time: str, value: str, left: str, right: str, names: tuple[str, str]
) -> DataFrame:
    """The two keys' values at exactly equal times, as their inner join on time gives them.

    A time that one side has twice gives every combination, nulls among the values included. Both sides
    are dealt by time and by blocks of at most about ``BLOCK_ROWS`` of a time's rows, every block of one side to
    every one of the other, so the largest group makes ``BLOCK_ROWS`` times ``BLOCK_ROWS`` combinations. The number
    of tasks is the session's: the rows are few against their combinations, so their bytes do not tell it.
    """
    rows = df.filter(F.col(key).isin(left, right) & F.col(time).isNotNull())
    sizes = rows.groupBy(F.col(time).alias("_at")).agg(
        F.count_if(F.col(key) == left).alias("_n_left"), F.count_if(F.col(key) == right).alias("_n_right")
    )
    sizes = sizes.filter((F.col("_n_left") > BLOCK_ROWS) | (F.col("_n_right") > BLOCK_ROWS))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def side(k: str, own: str, other: str, own_block: str, other_block: str, name: str) -> DataFrame:
        blocks = lambda n: F.coalesce(F.ceil(F.col(n) / BLOCK_ROWS), F.lit(1)).cast("int")
        dealt = rows.filter(F.col(key) == k).select(F.col(time), F.col(value).alias(name))
        dealt = dealt.withColumn("_place", F.monotonically_increasing_id())
        dealt = dealt.join(F.broadcast(sizes), F.col(time) == F.col("_at"), "left")
        met = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), blocks(other)) - 1))
        mine = F.pmod(F.xxhash64("_place"), F.greatest(F.lit(1), blocks(own))).cast("int")
        dealt = dealt.select(time, name, mine.alias(own_block), met.alias(other_block))
        return dealt.repartition(tasks, time, "_left_block", "_right_block")

    lefts = side(left, "_n_left", "_n_right", "_left_block", "_right_block", "_left")
    rights = side(right, "_n_right", "_n_left", "_right_block", "_left_block", "_right")
    both = lefts.join(rights, [time, "_left_block", "_right_block"])
    return both.select(time, F.col("_left").alias(names[0]), F.col("_right").alias(names[1]))


def correlation(df: DataFrame, a: str, b: str, name: str = "correlation") -> DataFrame:
    """Pearson correlation over pairs without null, as a one-row frame.

    Null under two pairs or without variance.
    """
    value = F.corr(a, b)
    return df.agg(F.when(~F.isnan(value), value).alias(name))
