from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest

from marketlens import sinks, sources
from marketlens.session import scratch_path


def _files(path, pattern):
    return sorted(Path(path).rglob(pattern))


def test_read_only_what_is_committed(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_plain(spark.range(3), path)
    assert sources.read_if_committed(spark, path).count() == 3
    (tmp_path / "t" / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError):
        sources.read_if_committed(spark, path)


def test_partitions_with_odd_names(spark, tmp_path):
    path = str(tmp_path / "t")
    names = ["Binance Bridged USDT (BNB Smart Chain)", "Bitcoin"]
    df = spark.createDataFrame([(n, i) for i in range(50) for n in names], "asset string, x int")
    sinks.write_partitioned(df.repartition(6), path, "asset")
    assert len(_files(path, "*.parquet")) == 2
    back = sources.read_if_committed(spark, path)
    assert back.columns == ["x", "asset"]
    assert {r.asset for r in back.select("asset").distinct().collect()} == set(names)
    pruned = back.filter("asset = 'Bitcoin'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(asset" in pruned


def test_overwrite_only_given_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int"), path, "k")
    sinks.write_partitioned(
        spark.createDataFrame([("b", 3)], "k string, x int"), path, "k", only_given=True
    )
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (3, "b")]
    sinks.write_partitioned(
        spark.createDataFrame([("b", 4)], "k string, x int"), path, "k", max_records=1
    )
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(4, "b")]


def test_names_in_the_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(
        spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int"), path, "k"
    )
    for _ in range(2):
        sinks.register_table(spark, "averages", path)
        assert sources.read_table(spark, "averages").count() == 2
    sinks.write_plain(spark.range(3), str(tmp_path / "other"))
    with pytest.raises(ValueError, match="another table"):
        sinks.register_table(spark, "averages", str(tmp_path / "other"))
    assert sources.read_table(spark, "averages").count() == 2
    rows = spark.sql("SELECT x FROM averages WHERE k = 'b'").collect()
    assert [r.x for r in rows] == [2]
    selected = sources.select_from(
        spark, "SELECT x FROM {t} WHERE k = 'a'", t=sources.read_table(spark, "averages")
    )
    assert [r.x for r in selected.collect()] == [1]
    spark.sql("DROP TABLE averages")
    assert _files(path, "*.parquet")


def test_csv_outputs(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", dt.datetime(2025, 3, 21)), ("b", dt.datetime(2025, 3, 22, 5))],
        "asset string, date timestamp",
    )
    daily = tmp_path / "daily"
    sinks.write_daily(df, str(daily))
    files = _files(daily, "*.csv")
    assert [f.parent.name for f in files] == ["day=20250321", "day=20250322"]
    assert files[0].read_text().splitlines()[0] == "asset,date"

    combined = tmp_path / "combined"
    for _ in range(2):
        sinks.write_combined(df.repartition(2), str(combined), single_file=True)
    assert len(_files(combined, "*.csv")) == 1
    assert len(_files(combined, "*.csv")[0].read_text().splitlines()) == 2

    appended = tmp_path / "appended"
    for _ in range(2):
        sinks.append_lines(df, str(appended))
    assert spark.read.csv(str(appended)).count() == 4


def test_small_results(spark, capsys):
    df = spark.range(5)
    assert sinks.first_rows(df, 3).count() == 3
    sinks.show_first(df, 2)
    assert "only showing top 2 rows" in capsys.readouterr().out
    assert len(sinks.to_local(df, max_rows=5)) == 5
    with pytest.raises(ValueError):
        sinks.to_local(df, max_rows=4)
    assert sinks.scalar_text(spark.sql("SELECT 0.6654D"), "correlation") == "correlation: 0.67"
    assert sinks.scalar_text(spark.sql("SELECT CAST(NULL AS DOUBLE)"), "c") == "c: null"


def test_jdbc_reader_needs_only_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        sources.read_jdbc(
            spark, "jdbc:nothing://host/db", "prices", "reader", "secret", "id", 0, 100, 4
        )


def test_scratch_is_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    assert one.startswith(root)
