from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlens.functions import (
    change_or_zero,
    columns_to_line,
    compact_day,
    day_start_text,
    epoch_seconds,
    european_day,
    field_or,
    is_anomaly,
    is_normal,
    line_to_struct,
    output_name,
    percent_change,
    segment_of,
    to_instant,
)


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_percent_change(spark):
    row = _one(
        spark,
        percent_change(F.lit(110.0), F.lit(100.0)),
        percent_change(F.lit(1.0), F.lit(0.0)),
        change_or_zero(F.lit(5.0), F.lit(None).cast("double")),
        change_or_zero(F.lit(5.0), F.lit(0.0)),
    )
    assert row[0] == 10.0
    assert row[1] is None
    assert row[2] == 0.0
    assert row[3] is None


def test_anomaly_sides(spark):
    changes = spark.createDataFrame([(3.0,), (-3.0,), (2.9,), (None,)], "c double")
    rows = changes.select(is_anomaly(F.col("c")), is_normal(F.col("c"))).collect()
    assert [tuple(r) for r in rows] == [(True, False), (True, False), (False, True), (None, None)]


def test_segment_is_case_sensitive_unless_normalized(spark):
    symbols = spark.createDataFrame([("USDT",), ("usdt",), ("BTC",), (None,)], "s string")
    rows = symbols.select(segment_of(F.col("s")), segment_of(F.col("s"), normalize=True)).collect()
    assert [tuple(r) for r in rows] == [
        ("stablecoin", "stablecoin"),
        ("volatile", "stablecoin"),
        ("volatile", "volatile"),
        ("volatile", "volatile"),
    ]


def test_both_timestamp_texts_and_junk(spark):
    row = _one(
        spark,
        to_instant(F.lit("2025-03-21 00:00:00")),
        to_instant(F.lit("2025-04-20T12:47:50.520Z")),
        to_instant(F.lit("yesterday?")),
        epoch_seconds(F.lit("2025-04-20T12:47:50.520Z")),
        epoch_seconds(F.lit("1969-12-31 23:59:59.5")),
    )
    assert row[0] == dt.datetime(2025, 3, 21)
    assert row[1] == dt.datetime(2025, 4, 20, 12, 47, 50, 520000)
    assert row[2] is None
    assert row[3] == 1745153270
    assert row[4] == -1


def test_date_forms(spark):
    day = F.lit("2025-03-21").cast("date")
    row = _one(spark, european_day(day), day_start_text(day), compact_day(day), output_name(day))
    assert tuple(row) == (
        "21-03-2025",
        "2025-03-21 00:00:00",
        "20250321",
        "snapshot_20250321.csv",
    )


def test_lines_that_do_not_fit_are_kept(spark):
    ok = "Bitcoin,BTC,2025-03-21 00:00:00,1.5,2.0,3.0,0.0,0.0,4.0,5.0"
    lines = [ok, ok + "\r", "Bitcoin,BTC,2025", ok + ",6.0", ok.replace("1.5", "cheap")]
    parsed = (
        spark.createDataFrame([(x,) for x in lines], "value string")
        .select(line_to_struct(F.col("value").cast("binary")).alias("d"))
        .select("d.*")
        .collect()
    )
    assert [r.price_usd for r in parsed[:2]] == [1.5, 1.5]
    assert [r._corrupt_record is None for r in parsed] == [True, True, False, False, False]


def test_line_roundtrip_with_quotes(spark):
    rows = spark.createDataFrame([('a "b", c', 7.722392071539077e-06)], "n string, x double")
    line = rows.select(columns_to_line("n", "x").alias("v"))
    back = line.select(line_to_struct(F.col("v"), rows.schema).alias("d")).select("d.n", "d.x")
    assert back.collect() == rows.collect()


def test_default_is_for_missing_only(spark):
    payloads = ['{"s": 2.5}', '{"s": null}', '{"t": 1}', '{"s": "many"}']
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    rows = df.select(field_or(F.parse_json("p"), "$.s", "double", 0.0)).collect()
    assert [r[0] for r in rows] == [2.5, None, 0.0, None]
