"""Move lines on: folder to topic, folder to folder, and random samples to a folder."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import columns_to_line
from ..operators.selection import draw_of, sample_rows


def kafka_records(lines: DataFrame) -> DataFrame:
    """Lines as Kafka records, with the origin as a header."""
    header = F.struct(F.lit("file").alias("key"), F.col("origin").cast("binary").alias("value"))
    return lines.select(
        F.col("value").cast("string").alias("value"), F.array(header).alias("headers")
    )


def relay_to_kafka(
    lines: DataFrame, servers: str, topic: str, checkpoint: str, batch_records: int = 1_000
) -> StreamingQuery:
    """Send lines to a Kafka topic. Needs the Kafka connector package.

    ``batch_records`` bounds one producer request, at the usual 1 KiB a line.
    """
    return (
        kafka_records(lines)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.batch.size", batch_records * 1_024)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def relay_to_lines(
    lines: DataFrame, folder: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Copy lines into text files of another folder, each line exactly once."""
    writer = lines.select("value").writeStream.format("text")
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(folder)


def write_sample(
    table: DataFrame, folder: str, n: int, batch: int, key: str, seed: int = 0
) -> None:
    """Write n rows drawn by ``key`` as headerless CSV into the batch's own folder.

    A repeated batch replaces its folder, so a restart adds nothing twice.
    """
    (
        sample_rows(table, n, key, seed + batch)
        .select(columns_to_line(*table.columns).alias("value"))
        .write.mode("overwrite")
        .text(f"{folder}/batch={batch}")
    )


def spool_samples(
    spark: SparkSession,
    table: Callable[[], DataFrame],
    folder: str,
    checkpoint: str,
    key: str,
    n: int = 100,
    every: str = "10 seconds",
    seed: int = 0,
) -> StreamingQuery:
    """Every few seconds write n random rows of a table to a folder.

    The table is read anew each time; while it is empty, nothing is written.
    """

    def write_batch(_: DataFrame, batch: int) -> None:
        rows = table()
        if not rows.isEmpty():
            write_sample(rows, folder, n, batch, key, seed)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


@dataclass(frozen=True)
class Draws:
    """A table dealt at random into folders, and how many rows each folder has."""

    path: str
    schema: T.StructType
    counts: dict[str, int]

    def folders(self, n: int, batch: int, seed: int) -> list[str]:
        """Folders with at least ``n`` rows together, from one that seed and batch choose."""
        names = sorted(self.counts)
        start = zlib.crc32(f"{seed}:{batch}".encode()) % max(1, len(names))
        chosen, rows = [], 0
        for name in names[start:] + names[:start]:
            if rows >= n:
                break
            chosen.append(name)
            rows += self.counts[name]
        return chosen


def deal(table: DataFrame, path: str, key: str, seed: int = 0, digits: int = 2) -> Draws:
    """Write a table once into 16 to the power of ``digits`` folders by a hash of seed and key.

    A folder is a random part of the table, so batches of a sample need not scan all of it.
    """
    dealt = table.withColumn("_draw", F.substring(draw_of(key, seed), 1, digits))
    dealt.hint("rebalance", "_draw").write.mode("overwrite").partitionBy("_draw").parquet(path)
    schema = T.StructType([*table.schema, T.StructField("_draw", T.StringType())])
    rows = table.sparkSession.read.schema(schema).parquet(path).groupBy("_draw").count().collect()
    return Draws(path, schema, {r["_draw"]: r["count"] for r in rows})


def drawn_rows(
    spark: SparkSession, draws: Draws, n: int, batch: int, key: str, seed: int = 0
) -> DataFrame:
    """``n`` rows for a batch, all from a few folders of the dealt table."""
    rows = spark.read.schema(draws.schema).parquet(draws.path)
    some = rows.filter(F.col("_draw").isin(draws.folders(n, batch, seed))).drop("_draw")
    return sample_rows(some, n, key, seed + batch)


def spool_draws(
    ticks: DataFrame,
    draws: Draws,
    folder: str,
    checkpoint: str,
    key: str,
    n: int = 100,
    every: str | None = "10 seconds",
    seed: int = 0,
) -> StreamingQuery:
    """For every batch of ``ticks`` write ``n`` random rows of a dealt table, as CSV.

    A batch has a folder of its own, which a repeat after a restart replaces with the same rows.
    ``every=None`` takes the ticks there are and ends.
    """
    spark = ticks.sparkSession

    def write_batch(_: DataFrame, batch: int) -> None:
        rows = drawn_rows(spark, draws, n, batch, key, seed)
        lines = rows.select(columns_to_line(*rows.columns).alias("value"))
        lines.write.mode("overwrite").text(f"{folder}/batch={batch}")

    writer = ticks.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    due = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**due).start()
