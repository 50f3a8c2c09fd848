"""Catalog and database readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole catalog table; Catalyst prunes what the query does not use."""
    return spark.table(name)


def select_from(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run a SQL text; ``{name}`` in it stands for the frame passed under that name."""
    return spark.sql(sql, **tables)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str,
    password: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A database table. With a numeric or date partition column it is read in parallel ranges."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, user=user, password=password, fetchsize=fetch_size, **options
    )
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=partitions,
        )
    return reader.load()
