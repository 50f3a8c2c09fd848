"""File readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import line_to_struct, to_instant
from ..schema import ASSET, BAD_TIME, CORRUPT, MALFORMED, REASON, SNAPSHOT_COLUMNS, TIME


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if there is a file or folder; any file system that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def is_committed(spark: SparkSession, path: str) -> bool:
    """True if the writer of a dataset folder finished, that is, left its ``_SUCCESS`` file."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def read_if_committed(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset whose writer finished; an error for one still being written."""
    if not is_committed(spark, path):
        raise FileNotFoundError(f"no _SUCCESS in {path}")
    return spark.read.parquet(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All text lines under one or more paths: ``value``, and the file as ``origin``."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("origin"))


def checked_lines(lines: DataFrame) -> DataFrame:
    """Lines of a batch or a stream as typed rows, plus ``line``, ``origin`` and ``reason``.

    ``reason`` is null for an accepted line. A line that does not fit the columns is malformed; one
    whose time is given and is no timestamp has a bad time. Its row keeps what could be read. Some
    files begin with a header and some do not, so header lines are told by their first field; they
    and blank lines are left out. Each line is parsed whole whatever columns the query uses.
    """
    text = F.col("value").cast("string")
    row = F.col("_row")
    bad_time = row[TIME].isNotNull() & to_instant(row[TIME]).isNull()
    return (
        lines.filter(F.trim(text) != "")
        .withColumn("_row", line_to_struct(text))
        .filter(F.coalesce(row[ASSET] != ASSET, F.lit(True)))
        .select(
            *[row[c].alias(c) for c in SNAPSHOT_COLUMNS],
            text.alias("line"),
            "origin",
            F.when(row[CORRUPT].isNotNull(), MALFORMED).when(bad_time, BAD_TIME).alias(REASON),
        )
    )
