"""Streams of CSV lines: a column ``value``, and where the line came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, starting: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def kafka_lines(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_per_batch: int | None = None,
) -> DataFrame:
    """Lines of a Kafka topic, from the earliest by default. Needs the Kafka connector package."""
    options = kafka_options(servers, topic, starting)
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value", "topic AS origin")
    )


def spool_lines(
    spark: SparkSession,
    folder: str,
    glob: str = "*.csv",
    files_per_batch: int = 1_000,
    delete_read: bool = False,
) -> DataFrame:
    """Lines of the files that arrive in a folder, with the file path as ``origin``.

    All files already there are read first. ``delete_read`` removes files once their batch is done.
    """
    return (
        spark.readStream.format("text")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("cleanSource", "delete" if delete_read else "off")
        .load(folder)
        .select("value", F.col("_metadata.file_path").alias("origin"))
    )
