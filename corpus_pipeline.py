"""A corpus pipeline of five stages over the documents table.

Quality filter, line de-duplication, near-duplicate removal, source mix, tokens. Each stage takes the
session, the documents its predecessor kept, and the folder of the tables; all but the last return
the columns of the documents, and each result is written before the next stage reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import lines, mixing, ngram_join, pieces, quality
from marketlens.llm.common import ship, stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; rejected ones go."""
    ship(spark)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.with_quality(docs, model, "__score")
    return scored.where(F.col("__score") >= quality.ACCEPT).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines cut out of the texts; ``n_chars`` follows the text."""
    cut = lines.without_boilerplate(docs).where("text <> '' OR n_removed = 0")
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that links join, one stays: that of the smallest id, null ids last, then the first row.

    A row stands for itself, whatever its id: rows that repeat an id or have none are kept or go by
    their own texts. Rows without words link with none and stay.
    """
    ship(spark)
    # Written once, so that a row has the same key in every read.
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    linked = ngram_join.linked(rows.select(F.col("__row").alias("doc_id"), "text"))
    groups = linked.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row")
    groups = stored(groups, "linked")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    first = groups.groupBy("component_id").agg(F.min(order)["__row"].alias("__row"))
    drop = groups.join(first, "__row", "left_anti").select("__row")
    return rows.join(drop, "__row", "left_anti").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: texts cut to the words it takes, repeats as rows of their own."""
    return mixing.mixed_texts(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, checked by decoding."""
    ship(spark)
    return pieces.encoded_rows(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", near_dedup),
    ("source_mix", source_mix),
    ("sentencepiece", tokens),
]

# A trained classifier and the piece search have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
