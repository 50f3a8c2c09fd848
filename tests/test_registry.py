"""Every registered query against its SQL on DuckDB, over the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from marketlens.registry import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql_and_is_handed_to_the_driver():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, str(FOLDER))
    rows = [tuple(r) for r in result.collect()]
    relation = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(relation.columns)
    assert _normal(rows, result.columns) == _normal(relation.fetchall(), relation.columns)


def test_entry(spark):
    assert driver.entry(spark).count() == 2
