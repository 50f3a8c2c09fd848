from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators.quality import (
    clean,
    counted,
    drop_duplicate_keys,
    duplicate_count,
    keep_first,
    null_counts,
    quality_report,
)
from marketlens.plans.features import clean_prices


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_by_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, o int, v string")
    rows = keep_first(df, ["k"], ["o"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", 1, "y"), ("b", 1, "z")]


def test_keep_first_thins_copies_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = _plan(keep_first(df, ["k"], ["id"]))
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:]


def test_survivor_does_not_depend_on_input_order(spark):
    rows = [("a", None, 1), ("a", 5, None), ("a", 5, 2), ("a", 7, 1)]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(order, "k string, x int, y int").repartition(3)
        assert [tuple(r) for r in drop_duplicate_keys(df, ["k"]).collect()] == [("a", 5, 2)]


def test_only_key_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert sorted(map(tuple, drop_duplicate_keys(df, ["a", "b"]).collect())) == [(1, 2), (1, 3)]


def test_clean_removes_a_key_whose_kept_copy_is_bad(spark):
    df = spark.createDataFrame([("a", -5.0), ("a", 9.0), ("b", 1.0)], "k string, x double")
    rows = clean(df, ["k"], ["x"], F.col("x") > 0).collect()
    assert [tuple(r) for r in rows] == [("b", 1.0)]


def test_clean_prices_edges(prices):
    day = "2025-03-21 00:00:00"
    rows = clean_prices(
        prices(
            ("A", "A", day, 1.0, 0.0, 0.0),
            ("B", "B", day, 0.0, 1.0, 1.0),
            ("C", "C", day, -1.0, 1.0, 1.0),
            ("D", "D", day, None, 1.0, 1.0),
            ("E", "E", day, 1.0, None, 1.0),
            ("F", "F", day, 1.0, 1.0, None),
            ("G", "G", day, 1.0, -1.0, 1.0),
            ("H", "H", day, 1.0, 1.0, 1.0),
            ("H", "H", day, 1.0, 1.0, 1.0),
        )
    )
    assert sorted(r.cryptocurrency for r in rows.collect()) == ["A", "H"]


def test_reports(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", None), ("a", 1), ("b", 2), (None, None), (None, 3)], "k string, x int"
    )
    assert quality_report(df, ["k"], ["k", "x"]).first().asDict() == {
        "row_count": 6,
        "duplicate_rows": 3,
        "null_k": 2,
        "null_x": 2,
    }
    assert duplicate_count(df, ["k"]).first()[0] == 3
    assert null_counts(df, ["k", "x"]).first().asDict() == {
        "row_count": 6,
        "null_k": 2,
        "null_x": 2,
        "any_null": True,
    }
    assert null_counts(df.na.drop(), ["k", "x"]).first()["any_null"] is False


def test_reports_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, x int")
    assert tuple(quality_report(empty, ["k"], ["x"]).first()) == (0, 0, 0)
    assert tuple(null_counts(empty, ["x"]).first()) == (0, 0, False)


def test_count_without_a_job_of_its_own(spark):
    watched, seen = counted(spark.range(7), "seven")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["row_count"] == 7
