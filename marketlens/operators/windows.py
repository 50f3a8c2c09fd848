"""Lagged values and trailing means per key.

A key is cut into time slices, so none of any size goes into one task, and the cost of a mean does
not grow with the rows in its frame. In ``sized_windows`` keys of few rows take the plain form, one window per
key: it moves each row once, and a frame has few rows to add. Both give the same values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_seconds
from ..schema import DAY_SECONDS
from .slices import SLICE_ROWS, UNDATED, day_number, large_keys, second_of, slice_starts, with_slice

# Keys of more rows are sliced. A plain mean costs a row as many additions as its frame has rows.
PLAIN_ROWS = 1_000


def plain_lags(
    df: DataFrame, key: str, order: Sequence[str], value: str, lags: Mapping[str, int]
) -> DataFrame:
    """Add the value ``lags[name]`` rows back as column ``name``."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({name: F.lag(value, k).over(window) for name, k in lags.items()})


def plain_trailing_means(
    df: DataFrame, key: str, time: str, value: str, means: Mapping[str, int]
) -> DataFrame:
    """Add the mean over the last ``means[name]`` days, both ends included, on whole seconds."""
    window = Window.partitionBy(key).orderBy(epoch_seconds(F.col(time)))
    return df.withColumns(
        {
            name: F.avg(value).over(window.rangeBetween(-days * DAY_SECONDS, 0))
            for name, days in means.items()
        }
    )


def sliced_windows(
    df: DataFrame,
    key: str,
    time: str,
    order: Sequence[str],
    value: str,
    lags: Mapping[str, int],
    means: Mapping[str, int],
    slice_rows: int = SLICE_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add lags (rows back) and trailing means (days) of ``value`` per key, in ``order``.

    Rows are shuffled once, by slice. Lags look within the slice, and what they miss at its start
    is joined from the slices before. Means are computed per second and travel with the rows in
    that same shuffle. A query that does not use the means does not compute them.

    ``key`` may be of any type that can be joined, and null is a key. ``order`` must begin with
    ``time`` and be free of ties. A mean has the type of ``avg``. Slices follow the row counts in
    ``counted``, by default ``df`` itself. It may hold more rows than ``df``, so a table before
    de-duplication serves, and costs less to count. No job runs before the result is asked for.
    """
    if order[0] != time:
        raise ValueError("order must begin with the time column")
    starts = slice_starts(df if counted is None else counted, key, time, slice_rows)
    # A hash of the key, never null, so that the shuffle by slice serves the join by slice as well.
    rows = with_slice(df.withColumn("_second", second_of(time)), key, "_second", starts)
    rows = rows.withColumn("_k", F.xxhash64(key))
    result = rows
    if means:
        averaged = means_by_second(rows, key, "_second", value, means)
        averaged = with_slice(averaged, key, "_second", starts).withColumn("_k", F.xxhash64(key))
        together = rows.withColumn("_is_row", F.lit(True)).unionByName(
            averaged, allowMissingColumns=True
        )
        same_second = Window.partitionBy("_k", key, "_slice", "_second")
        result = (
            together.repartition("_k", "_slice")
            .withColumns({name: F.max(name).over(same_second) for name in means})
            .filter("_is_row")
        )
    if lags:
        result = _with_sliced_lags(result, rows, key, order, value, lags)
    return result.select(*df.columns, *lags, *means)


def sized_windows(
    df: DataFrame,
    key: str,
    time: str,
    order: Sequence[str],
    value: str,
    lags: Mapping[str, int],
    means: Mapping[str, int],
    slice_rows: int = SLICE_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """As ``sliced_windows``, which only keys of more than ``PLAIN_ROWS`` rows (or ``slice_rows``) need.

    The rows of all others are shuffled once, by key, and nothing else of them is. A list in all tasks tells
    the large keys; rows are counted in ``counted``.
    """
    counted = df if counted is None else counted
    large = large_keys(counted, key, min(slice_rows, PLAIN_ROWS))
    of_large = lambda rows, how: rows.join(
        F.broadcast(large), F.col(key).eqNullSafe(F.col("_large_key")), how
    )
    plain = plain_lags(of_large(df, "left_anti"), key, order, value, lags)
    plain = plain_trailing_means(plain, key, time, value, means)
    sliced = sliced_windows(
        of_large(df, "left_semi"),
        key,
        time,
        order,
        value,
        lags,
        means,
        slice_rows,
        of_large(counted, "left_semi"),
    )
    return plain.select(*sliced.columns).unionByName(sliced)


def _with_sliced_lags(
    df: DataFrame,
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    lags: Mapping[str, int],
) -> DataFrame:
    """Add the lags of the sliced ``rows`` to ``df``, which holds the same rows.

    A slice's own last rows (at most the largest offset each) are lined up per key; the values
    before a slice's first row make a short array, which is joined to the slice's rows.
    """
    depth = max(lags.values())
    backwards = Window.partitionBy(key, "_slice").orderBy(
        *[F.col(c).desc_nulls_last() for c in order]
    )
    tails = (
        rows.select(key, "_slice", *order, value)
        .withColumn("_rank", F.row_number().over(backwards))
        .filter(F.col("_rank") <= depth)
    )
    along = Window.partitionBy(key).orderBy("_slice", *order)
    carried = (
        tails.withColumns(
            {
                "_before": F.array(*[F.lag(value, i).over(along) for i in range(1, depth + 1)]),
                "_last_slice": F.lag("_slice").over(along),
            }
        )
        .filter(F.col("_last_slice") < F.col("_slice"))
        .select(
            F.col(key).alias("_key"),
            F.xxhash64(key).alias("_of"),
            F.col("_slice").alias("_at"),
            "_before",
        )
    )
    within = Window.partitionBy("_k", key, "_slice").orderBy(*order)
    near = df.withColumns(
        {
            "_row": F.row_number().over(within),
            **{f"_near_{name}": F.lag(value, k).over(within) for name, k in lags.items()},
        }
    )
    joined = near.join(
        carried,
        (F.col("_k") == F.col("_of"))
        & (F.col("_slice") == F.col("_at"))
        & F.coalesce(F.col(key) == F.col("_key"), F.col(key).isNull() & F.col("_key").isNull()),
        "left",
    )
    return joined.select(
        *df.columns,
        *[
            F.when(F.col("_row") > k, F.col(f"_near_{name}"))
            .otherwise(F.get("_before", (F.lit(k) - F.col("_row")).cast("int")))
            .alias(name)
            for name, k in lags.items()
        ],
    )


def means_by_second(
    df: DataFrame, key: str, second: str, value: str, means: Mapping[str, int]
) -> DataFrame:
    """Trailing means per key and second that occurs: the key, the second and the means.

    Frames are on whole seconds, so rows first combine to one sum and count per second. A frame
    of d days ending at t is then: t's own day up to t, the d - 1 whole days before it, and the
    rest of the day d days back from the same time of day on. For the last part each second
    is also sent d days forward, where a running sum from the end of the day picks it up. All
    parts are added, never subtracted, so no precision is lost; a group holds at most one day's
    seconds per part.
    """
    lengths = sorted(set(means.values()))
    given, mean_type = df.schema[value].dataType, df.select(F.avg(value)).schema[0].dataType
    # Sums as avg makes them: of doubles for whole numbers, with ten more digits for decimals.
    sum_type = T.DoubleType()
    if isinstance(given, T.DecimalType):
        sum_type = T.DecimalType(min(38, given.precision + 10), given.scale)
    seconds = df.groupBy(key, second).agg(
        F.sum(F.col(value) if isinstance(given, T.DecimalType) else F.col(value).cast("double"))
        .cast(sum_type)
        .alias("_sum"),
        F.count(value).alias("_n"),
    )

    by_day = Window.partitionBy("_key").orderBy("_of_day")
    whole_days = (
        seconds.groupBy(
            F.col(key).alias("_key"), day_number(F.col(second)).alias("_of_day")
        )
        .agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
        .select(
            "_key",
            "_of_day",
            *[
                F.sum(part).over(by_day.rangeBetween(1 - days, -1)).alias(f"_whole{part}_{days}")
                for days in lengths
                for part in ("_sum", "_n")
            ],
        )
    )

    sent = [
        F.struct(
            F.lit(days).alias("_ahead"), (F.col(second) + days * DAY_SECONDS).alias("_at")
        )
        for days in (0, *lengths)
    ]
    parts = (
        seconds.withColumn("_sent", F.explode(F.array(*sent)))
        .select(key, "_sent._ahead", "_sent._at", "_sum", "_n")
        .filter((F.col("_ahead") == 0) | (F.col("_at") >= UNDATED + 2 * max(lengths) * DAY_SECONDS))
        .withColumn("_day", day_number(F.col("_at")))
    )
    forward = Window.partitionBy(key, "_day").orderBy("_at")
    from_end = Window.partitionBy(key, "_day").orderBy(F.desc("_at"))

    def running(part: str, ahead: int, window: WindowSpec) -> Column:
        return F.sum(F.when(F.col("_ahead") == ahead, F.col(part))).over(window)

    summed = parts.withColumns(
        {f"_own{part}": running(part, 0, forward) for part in ("_sum", "_n")}
        | {
            f"_rest{part}_{days}": running(part, days, from_end)
            for days in lengths
            for part in ("_sum", "_n")
        }
    ).filter(F.col("_ahead") == 0)
    placed = summed.join(
        whole_days,
        F.col(key).eqNullSafe(F.col("_key")) & (F.col("_day") == F.col("_of_day")),
        "left",
    )

    def total(part: str, days: int) -> Column:
        own, rest, whole = (
            F.coalesce(F.col(c), F.lit(0))
            for c in (f"_own{part}", f"_rest{part}_{days}", f"_whole{part}_{days}")
        )
        return own + rest + whole if part == "_n" else (own + rest + whole).cast(sum_type)

    return placed.select(
        key,
        F.col("_at").alias(second),
        *[
            F.try_divide(total("_sum", days), total("_n", days)).cast(mean_type).alias(name)
            for name, days in means.items()
        ],
    )
