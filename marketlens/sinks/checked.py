"""Accepted rows and rejected lines, written in one pass into one dataset of two folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import REASON, SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA

_KEPT = "accepted"
_SCHEMA = T.StructType(
    [*SNAPSHOT_SCHEMA, *[T.StructField(c, T.StringType()) for c in ("line", "origin", REASON, _KEPT)]]
)


def _marked(checked: DataFrame) -> DataFrame:
    """Accepted rows need their line no more."""
    good = F.col(REASON).isNull()
    return checked.withColumns(
        {
            _KEPT: F.when(good, "yes").otherwise("no"),
            "line": F.when(~good, F.col("line")),
        }
    )


def write_checked(checked: DataFrame, path: str) -> None:
    """Overwrite with checked lines; neither folder takes a pass of its own."""
    _marked(checked).write.mode("overwrite").partitionBy(_KEPT).parquet(path)


def stream_checked(
    checked: DataFrame, path: str, checkpoint: str, available_only: bool = False
) -> StreamingQuery:
    """Append checked lines of a stream, each exactly once."""
    writer = _marked(checked).writeStream.format("parquet").partitionBy(_KEPT)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_only else writer).start()


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """The rows of accepted lines; the other folder is not read."""
    table = spark.read.schema(_SCHEMA).parquet(path)
    return table.filter(F.col(_KEPT) == "yes").select(*SNAPSHOT_COLUMNS)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines, why, and where they came from."""
    table = spark.read.schema(_SCHEMA).parquet(path)
    return table.filter(F.col(_KEPT) == "no").select("line", REASON, "origin")
