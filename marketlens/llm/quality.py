"""Quality score of documents by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled texts. A text that
compresses better with the good dictionary resembles good texts. Whole texts are compressed in
pieces, each with the dictionary alone, so the difference does not fade with length:

    x = (bad size - good size) / (bad size + good size)

A logistic curve fitted on other labelled rows turns ``x`` into a probability.

The fit is bounded: at most ``SAMPLE_ROWS`` labelled texts per class for the dictionaries and twice
as many for the curve, chosen by a hash of the id, and at most ``SAMPLE_CHARS`` characters of each
for the dictionaries. Scoring has no bound. Null and empty texts have ``x = 0``; without labels of
both classes every score is the share of good labels (one half without any).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import id_crc, whole_text

SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 8_192
PIECE = 1_024
DICTIONARY = 112_640
LEVEL = 3
ACCEPT = 0.7


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(id_crc(), F.lit(4)) == 2


def _dictionary(texts: list[str]) -> bytes:
    pieces = [p for t in texts for p in _pieces(t.encode("utf-8", "replace"))]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too few samples: the samples themselves serve
        return b"".join(pieces)[-DICTIONARY:]


def _pieces(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(data) if data else None
    if dictionary is not None:
        dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=dictionary,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


def size_difference(text: str, good, bad) -> float:
    """The normalised difference of the text's two compressed sizes."""
    pieces = _pieces(text.encode("utf-8", "replace"))
    a = sum(len(good.compress(p)) for p in pieces)
    b = sum(len(bad.compress(p)) for p in pieces)
    return (b - a) / (b + a) if pieces else 0.0


def compressed_difference(text: Column, good: bytes, bad: bytes) -> Column:
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a, b = _compressor(good), _compressor(bad)
        for texts in batches:
            yield pd.Series([size_difference(t, a, b) for t in texts], dtype="float64")

    # The annotations above choose the iterator form of the function.
    scored.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(scored, "double")(text)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a weak pull to zero."""
    scale = 50.0
    design = np.stack([x * scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - 1e-3 * w
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] * scale), float(w[1])


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from labelled rows that are not held out; see the module for the bounds."""
    labelled = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .withColumn("order", F.xxhash64("doc_id", F.lit("quality")))
    )
    for_curve = F.pmod("order", F.lit(3)) == 0
    picks = [
        (labelled.where(~for_curve & (F.col("quality") == 1)), SAMPLE_ROWS),
        (labelled.where(~for_curve & (F.col("quality") == 0)), SAMPLE_ROWS),
        (labelled.where(for_curve), 2 * SAMPLE_ROWS),
    ]
    chosen = [p.orderBy("order", "doc_id", "quality").limit(n) for p, n in picks]
    texts = docs.select("doc_id", whole_text().alias("text"))
    # At most SAMPLE_ROWS ids: safe to send to every task.
    good, bad = (
        [
            r[0]
            for r in texts.join(F.broadcast(c), "doc_id")
            .select(_some_chars(F.col("text"), F.col("order")), "order", "doc_id")
            .orderBy("order", "doc_id")
            .limit(SAMPLE_ROWS)
            .collect()
        ]
        for c in chosen[:2]
    )
    good_bytes, bad_bytes = _dictionary(good), _dictionary(bad)
    curve = (
        texts.join(F.broadcast(chosen[2]), "doc_id")
        .select("quality", compressed_difference(F.col("text"), good_bytes, bad_bytes).alias("x"))
        .limit(4 * SAMPLE_ROWS)
        .collect()
    )
    y = np.array([r["quality"] for r in curve], dtype=float)
    x = np.array([r["x"] for r in curve], dtype=float)
    if len(set(y)) < 2 or not good or not bad:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return QualityModel(good_bytes, bad_bytes, 0.0, math.log(share / (1 - share)))
    return QualityModel(good_bytes, bad_bytes, *_logistic(x, y))


def _some_chars(text: Column, order: Column) -> Column:
    """The text, or a stretch of ``SAMPLE_CHARS`` from a place the hash chooses."""
    room = F.greatest(F.char_length(text) - SAMPLE_CHARS, F.lit(0)) + 1
    return F.substring(text, (F.pmod(order, room) + 1).cast("int"), F.lit(SAMPLE_CHARS))


def with_quality(docs: DataFrame, model: QualityModel, score: str = "score") -> DataFrame:
    """``docs`` with the score from 0 to 1 of each whole text in column ``score``.

    A column of that name is replaced, all others are kept. Null texts count as empty; repeated rows,
    and texts that are equal, get the same score. An empty table gives an empty result.
    """
    x = compressed_difference(whole_text(), model.good, model.bad)
    return docs.withColumn(score, 1 / (1 + F.exp(-(x * model.slope + model.offset))))
