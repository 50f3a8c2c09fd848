"""The feature table grown by new days, without computing the old ones again.

The table has a folder per day. What a new day needs of the past is little: the rows of the longest
trailing mean's days, read from the table's last folders, and each asset's last rows before the
day, as many as the largest lag. The latter are kept as a table of their own, one folder per
load, so that they can be older than any mean and a load that failed or is repeated finds the same
past again. Results equal those of the table built at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.slices import SLICE_ROWS
from ..schema import (
    ASSET,
    FEATURE_COLUMNS,
    FEATURE_SCHEMA,
    LAG_ROWS,
    STABLE_SYMBOLS,
    SYMBOL,
    TIME,
    TRAILING_DAYS,
)
from ..sinks.parquet import write_partitioned, write_plain
from ..sources.files import path_exists
from .features import clean_prices, features_of

DAY = "day"


@dataclass(frozen=True)
class Load:
    """First and last day that a load wrote; both are null if it had no rows."""

    first: str | None
    last: str | None


def _folders(spark: SparkSession, path: str, name: str) -> list[str]:
    """The days there are folders of, in order; no column of the files is read."""
    if not path_exists(spark, path):
        return []
    rows = spark.read.schema(f"{name} string").parquet(path).select(name).distinct().collect()
    return sorted(r[name] for r in rows)


def read_grown(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table in its column order, and the day."""
    schema = T.StructType([*FEATURE_SCHEMA, T.StructField(DAY, T.StringType())])
    return spark.read.schema(schema).parquet(f"{folder}/features").select(*FEATURE_COLUMNS, DAY)


def grow(
    prices: DataFrame,
    folder: str,
    stable_symbols: Iterable[str] = STABLE_SYMBOLS,
    normalize_symbol: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> Load:
    """Add the days of ``prices`` to the table in ``folder``, or replace them if they are its last.

    Only folders of these days are written. Days must come in order: prices of a day before one
    that is there already and not given again are refused, since the later days depend on them.
    Rows without time belong to no day and are left out; ``undated`` finds them. The clean rows of the
    load are written first, to a folder that the next load overwrites, so ``prices`` are read and
    de-duplicated once.
    """
    spark = prices.sparkSession
    features, tails, load = f"{folder}/features", f"{folder}/tails", f"{folder}/load"
    cleaned = clean_prices(prices).filter(F.col(TIME).isNotNull())
    write_plain(cleaned.withColumn(DAY, F.date_format(TIME, "yyyy-MM-dd")), load)
    cleaned = spark.read.parquet(load)
    given = sorted(r[DAY] for r in cleaned.select(DAY).distinct().collect())
    if not given:
        return Load(None, None)
    first, last = given[0], given[-1]
    there = _folders(spark, features, DAY)
    loads = [d for d in _folders(spark, tails, "load") if d < first]
    stale = [d for d in there if d >= first and d not in set(given)]
    if stale:
        raise ValueError(f"days from {first} on must be given again, {stale[0]} is not")
    broken = [d for d in there if (loads[-1] if loads else "") < d < first]
    if broken:
        raise ValueError(f"the load of {broken[0]} did not finish and must be repeated first")

    columns = cleaned.columns
    past = _past(spark, folder, loads[-1], first, columns) if loads else None
    rows = cleaned.withColumn("_new", F.lit(True))
    if past is not None:
        rows = rows.unionByName(past.withColumn("_new", F.lit(False)))
    added = features_of(rows, stable_symbols, normalize_symbol, slice_rows).filter("_new")
    write_partitioned(added.select(*FEATURE_COLUMNS, DAY), features, DAY, only_given=True)
    # Last of all, so that a load that failed before is repeated from the same past.
    write_partitioned(_tails(rows.drop("_new"), last), tails, "load", only_given=True)
    return Load(first, last)


def undated(prices: DataFrame) -> DataFrame:
    """Rows that belong to no day."""
    return prices.filter(F.col(TIME).try_cast("timestamp").isNull())


def _past(
    spark: SparkSession, folder: str, load: str, first: str, columns: list[str]
) -> DataFrame:
    """Rows before ``first`` that windows of later days may reach."""
    reach = F.date_sub(F.lit(first).cast("date"), max(TRAILING_DAYS.values())).cast("string")
    table = read_grown(spark, folder)
    near = table.filter((F.col(DAY) >= reach) & (F.col(DAY) < F.lit(first))).select(*columns)
    schema = T.StructType([*near.schema, T.StructField("load", T.StringType())])
    tails = spark.read.schema(schema).parquet(f"{folder}/tails")
    older = tails.filter((F.col("load") == load) & (F.col(DAY) < reach)).select(*columns)
    return near.unionByName(older)


def _tails(rows: DataFrame, load: str) -> DataFrame:
    """Each asset's last rows, as many as the largest lag; the limit cuts before the shuffle too."""
    backwards = Window.partitionBy(ASSET).orderBy(F.desc(TIME), F.desc_nulls_last(SYMBOL))
    return (
        rows.withColumn("_rank", F.row_number().over(backwards))
        .filter(F.col("_rank") <= max(LAG_ROWS.values()))
        .drop("_rank")
        .withColumn("load", F.lit(load))
    )
