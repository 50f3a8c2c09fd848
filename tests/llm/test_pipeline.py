"""The registered text queries and the pipeline over the smallest driver tables."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from test_ngram_join import brute

import corpus_pipeline
from marketlens.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the driver tables")


def test_all_queries_are_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(QUERIES, key=lambda n: int(re.match(r"op(\d+)_", n)[1]))] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = QUERIES[name](spark, SMALL)
    columns = sorted(result.columns)
    want = duck.sql(ORACLES[name])
    assert columns == sorted(want.columns)
    pick = ", ".join(columns)
    rows = sorted(tuple(map(repr, r)) for r in result.select(*columns).collect())
    assert rows == sorted(tuple(map(repr, r)) for r in duck.sql(f"SELECT {pick} FROM ({ORACLES[name]})").fetchall())


def test_stages_do_their_work(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        kept[name] = docs
        if name != "sentencepiece":
            assert docs.columns == columns
        if name == "ngram_jaccard":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = sorted(i for i, _, c in brute(rows) if i == c)
            assert sorted(r["doc_id"] for r in docs.collect()) == want
    mixed = Counter(r["doc_id"] for r in kept["source_mix"].collect())
    assert max(mixed.values()) <= 3
    assert all(r["round_trip"] for r in kept["sentencepiece"].collect())
    assert kept["sentencepiece"].count() == kept["source_mix"].count()


def test_one_row_of_each_component_stays(spark, docs):
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [
        (1, text("a")), (None, text("a") + " more"),  # a null id linked with an id
        (None, text("b")),  # a clean null id
        (None, text("c")), (None, text("c")),  # null ids that link with each other only
        (2, text("d")), (2, text("d")),  # a repeated row
        (3, text("a")), (3, text("e")),  # one id: a copy of a smaller one, and a clean text
        (None, None), (4, ""), (4, ""),
    ]
    got = corpus_pipeline.near_dedup(spark, docs(*rows), SMALL)
    want = [rows[i] for i in (0, 2, 3, 5, 8, 9, 10, 11)]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(want)
