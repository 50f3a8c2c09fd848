"""Parquet datasets and their names in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str,
    only_given: bool = False,
    max_records: int = 0,
) -> None:
    """Overwrite a dataset laid out in one folder per value of ``by``.

    Rows are rebalanced by that column first: a value's rows meet in few tasks, hence few files,
    and a value too large for one task is spread over several. ``only_given`` replaces just the
    folders that occur in ``df``, for daily loads.
    """
    writer = (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .partitionBy(by)
        .option("partitionOverwriteMode", "dynamic" if only_given else "static")
    )
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def write_plain(df: DataFrame, path: str) -> None:
    """Overwrite an unpartitioned dataset."""
    df.write.mode("overwrite").parquet(path)


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Give a written Parquet dataset, with its partitions, a name in the catalog.

    The files stay where they are. A name that another dataset has is refused, never dropped.
    """
    if spark.catalog.tableExists(name):
        quoted = ".".join(f"`{part}`" for part in name.split("."))
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").collect()
        place = next((r["data_type"] for r in told if r["col_name"] == "Location"), "")
        bare = lambda p: p.removeprefix("file:").replace("//", "/").rstrip("/")
        if bare(place) != bare(path):
            raise ValueError(f"{name} is the name of another table")
        spark.catalog.refreshTable(name)
        table = spark.table(name)
    else:
        table = spark.catalog.createTable(name, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return table
