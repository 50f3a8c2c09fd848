from __future__ import annotations

import random
from pathlib import Path

import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text[, source]); other columns filled in."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    if not Path(SMALL).exists():
        pytest.skip("needs the driver tables")
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, other scripts."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "été", "日本", "x" * 40, "\U0001f600", "k1", "7"]
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "one two three"),
        (5, "one two three"),
        (None, "one two three"),
        (6, long_text),
        (7, long_text),
        (8, "A▁B  c  \n tail "),
        (9, "y" * 50_000),
        (10, "Alpha beta\ngamma\r\ndelta"),
    ]
