"""Exact de-duplication of a batch of documents against an immutable snapshot.

A snapshot is a table of digests with one binary fuse filter per bucket of digests. The digests of
a new batch are grouped among themselves first (so a group of copies of any size is one row), then
screened by the filter of their bucket. Positives are looked up in the bucket's exact digests. Only
texts whose digest occurs more than once travel: they are grouped by all their bytes, which is the
byte check.

Null texts count as empty. Null ids are smaller than any id; a group with null ids alone is kept
under a null id. Rows that repeat both id and text are all returned, and one of them is kept. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm import fuse
from marketlens.llm.common import stored, whole_text

# Digests per filter; a bucket is one group of rows in a task.
BUCKET_KEYS = 32_768


@dataclass(frozen=True)
class Snapshot:
    """Distinct digests with counts, and their filters; both tables are never changed."""

    digests: DataFrame
    filters: DataFrame
    buckets: int


def digest_rows(docs: DataFrame) -> DataFrame:
    """Per distinct (id, text): 64-bit digest, SHA-256, number of equal rows."""
    return (
        docs.select("doc_id", whole_text().alias("text"))
        .select(
            "doc_id",
            F.xxhash64("text").alias("digest"),
            F.sha2("text", 256).alias("text_sha256"),
        )
        .groupBy("doc_id", "digest", "text_sha256")
        .agg(F.count("*").alias("copies"))
    )


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.sum("copies").alias("n"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("digest"), F.lit(buckets))


def take_snapshot(rows: DataFrame) -> Snapshot:
    """Write the distinct digests of ``rows`` and a filter for each bucket of them."""
    digests = stored(_grouped(rows), "snapshot")
    buckets = digests.count() // BUCKET_KEYS + 1

    def one_filter(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        data = fuse.build(part["digest"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"bucket": [key[0]], "filter": [data]})

    filters = (
        digests.select("digest", _bucket(buckets).alias("bucket"))
        .groupBy("bucket")
        .applyInPandas(one_filter, "bucket long, filter binary")
    )
    return Snapshot(digests, stored(filters, "filters"), buckets)


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The batch's digests that may be in the snapshot (all that are, few others).

    A bucket's part of the batch is cut into slices of about ``BUCKET_KEYS`` digests, each of which
    gets the bucket's filter: a group is bounded however much larger the batch is than the snapshot.
    """
    slices = batch.count() // (snapshot.buckets * BUCKET_KEYS) + 1
    slice_of = F.pmod(F.floor(F.col("digest") / snapshot.buckets), F.lit(slices))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))
    sent = snapshot.filters.withColumn("slice", F.explode(numbers))

    def probe(key: tuple, part: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if part.empty or filters.empty:
            return part[["digest"]].iloc[:0]
        keys = part["digest"].to_numpy(np.int64).view(np.uint64)
        return part.loc[fuse.maybe_in(filters["filter"].iloc[0], keys), ["digest"]]

    return (
        batch.select("digest", _bucket(snapshot.buckets).alias("bucket"), slice_of.cast("long").alias("slice"))
        .groupBy("bucket", "slice")
        .cogroup(sent.groupBy("bucket", "slice"))
        .applyInPandas(probe, "digest long")
    )


def repeated_digests(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Digests that occur more than once: in the batch, in the snapshot, or in both."""
    found = screen(batch, snapshot).join(snapshot.digests, "digest", "left_semi")
    return (
        found.unionByName(batch.where("n > 1").select("digest"))
        .unionByName(snapshot.digests.where("n > 1").select("digest"))
        .distinct()
    )


def exact_groups(docs: DataFrame, in_snapshot: Column) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of rows with the same text the one with the largest id stays. ``in_snapshot`` tells by the id
    which rows form the snapshot; the others are the new batch.
    """
    rows = stored(digest_rows(docs), "digests")
    old = F.coalesce(in_snapshot, F.lit(False))
    snapshot = take_snapshot(rows.where(old))
    batch = stored(_grouped(rows.where(~old)), "batch")
    repeated = stored(repeated_digests(batch, snapshot), "repeated")

    ids = rows.join(repeated, "digest", "left_semi").select("doc_id").distinct()
    texts = docs.select("doc_id", whole_text().alias("text")).alias("d")
    groups = (
        texts.join(ids.alias("i"), F.expr("d.doc_id <=> i.doc_id"), "left_semi")
        .groupBy("text")
        .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        .select(F.sha2("text", 256).alias("text_sha256"), "group_size", "keep_id", F.lit(True).alias("hit"))
    )
    groups = stored(groups, "groups")
    alone = F.col("hit").isNull()
    return (
        rows.join(groups, "text_sha256", "left")
        .select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            "text_sha256",
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        )
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.expr("doc_id <=> keep_id") & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
