"""Connected components of a graph given as pairs, by spreading the smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import stored


def connected(edges: DataFrame, label: str = "label") -> DataFrame:
    """``node`` and the smallest node that it reaches, for the nodes of the pairs ``a, b``.

    Each round takes the smallest label around and then the label of that label, so chains halve.
    Both are joins and sums that combine on the map side; a node of any degree is no single task.
    Every round is written, so a lost executor repeats one round at most.
    """
    pairs = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(pairs.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            pairs.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        best = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        after = best.join(jump, "mid").select("node", F.least("mid", "far").alias("label"), "old")
        after = stored(after, "labels")
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels.withColumnRenamed("label", label)
