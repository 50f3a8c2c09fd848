"""Sorting, top-k, pages, samples and key-set filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_keys(df: DataFrame, key: str, measure: Column, k: int) -> DataFrame:
    """The k keys with the largest measure; the key itself breaks ties."""
    return (
        df.groupBy(key)
        .agg(measure.alias("_measure"))
        .orderBy(F.desc_nulls_last("_measure"), key)
        .limit(k)
        .select(key)
    )


def keep_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys, on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys, on, "left_anti")


def page(df: DataFrame, order: Sequence[str | Column], number: int, per_page: int) -> DataFrame:
    """Page ``number`` (from 1) of the ordered rows. ``order`` should end in a unique column."""
    return df.orderBy(*order).offset((number - 1) * per_page).limit(per_page)


@dataclass(frozen=True)
class Pages:
    """A table written in order of ranges, and how many rows each range has."""

    rows: DataFrame
    order: list[Column]
    counts: dict[int, int]

    def page(self, number: int, per_page: int) -> DataFrame:
        """Page ``number`` (from 1), with the rank of each row as ``rank``, from 1.

        Only the ranges that the page touches are read, each ranked on its own; their first ranks
        follow from the counts. However deep the page, no task sorts more than a range.
        """
        first, last = (number - 1) * per_page + 1, number * per_page
        before, seen = {}, 0
        for part, n in sorted(self.counts.items()):
            if seen < last and seen + n >= first:
                before[part] = seen
            seen += n
        offset = F.lit(0)
        for part, n in before.items():
            offset = F.when(F.col("_range") == part, F.lit(n)).otherwise(offset)
        within = F.row_number().over(Window.partitionBy("_range").orderBy(*self.order))
        return (
            self.rows.filter(F.col("_range").isin(list(before)))
            .withColumn("rank", (within + offset).cast("long"))
            .filter(F.col("rank").between(first, last))
            .drop("_range")
        )


def ranked_pages(df: DataFrame, order: Sequence[str | Column], path: str, ranges: int) -> Pages:
    """Write a table once by ranges of ``order``, which should end in a unique column, for pages.

    The cuts come from a sample, so ranges are of about the same size; any cuts give the same pages.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(ranges, *columns).withColumn("_range", F.spark_partition_id())
    ranged.write.mode("overwrite").partitionBy("_range").parquet(path)
    schema = T.StructType([*df.schema, T.StructField("_range", T.IntegerType())])
    rows = df.sparkSession.read.schema(schema).parquet(path)
    counts = {r["_range"]: r["count"] for r in rows.groupBy("_range").count().collect()}
    return Pages(rows, columns, counts)


def draw_of(key: str, seed: int) -> Column:
    """A hash of the seed and a key, the same on any layout of the files."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows drawn without replacement: the top n by a hash of the seed and a unique key.

    The same seed draws the same rows whatever the layout of the files. Not a full sort.
    """
    return df.orderBy(draw_of(key, seed), key).limit(n)
