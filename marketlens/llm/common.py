"""Helpers that several text operators share."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_path

# White space that ends a word, as Java and DuckDB patterns write it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks it ran, not the plan below the table.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column), F.lit(""))


def id_crc(column: str = "doc_id") -> Column:
    """CRC-32 of the id's decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def chosen_texts(texts: DataFrame, n: int, seed: str) -> list[str]:
    """At most ``n`` texts of ``doc_id, text``, chosen by a hash of the id.

    The ids are chosen first; texts come to the driver for the chosen ids alone.
    """
    rows = texts.withColumn("order", F.xxhash64("doc_id", F.lit(seed)))
    ids = rows.select("order").orderBy("order").limit(n).distinct()
    found = rows.join(F.broadcast(ids), "order").orderBy("order", "doc_id", "text").limit(n)
    return [r["text"] for r in found.select("text").collect()]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless they find it as the driver does."""
    root = str(Path(__file__).resolve().parents[2])
    if root not in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
        _shipped(spark.sparkContext, root)


@functools.cache
def _shipped(context, root: str) -> None:
    target = os.path.join(tempfile.mkdtemp(), "package")
    context.addPyFile(shutil.make_archive(target, "zip", root, Path(__file__).parents[1].name))
