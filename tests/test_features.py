from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlens.plans.analytics import segment_aggregates
from marketlens.plans.features import asset_metrics, price_features, segment_rows
from marketlens.schema import SNAPSHOT_COLUMNS


def _days(asset, symbol, values, start=dt.date(2025, 3, 1)):
    return [
        (asset, symbol, f"{start + dt.timedelta(days=i)} 00:00:00", float(v))
        for i, v in enumerate(values)
    ]


def _by_date(df, asset):
    return df.filter(F.col("cryptocurrency") == asset).orderBy("date").collect()


def test_columns_changes_and_means(prices):
    features = price_features(prices(*_days("Bitcoin", "BTC", range(100, 140))))
    assert features.columns == [
        *SNAPSHOT_COLUMNS,
        "prev_price_24h",
        "prev_price_7d",
        "segment",
        "avg_price_7d",
        "avg_price_30d",
    ]
    rows = _by_date(features, "Bitcoin")
    assert rows[0].prev_price_24h is None and rows[0].price_change_percent_24h == 0.0
    assert rows[6].prev_price_7d is None and rows[6].price_change_percent_7d == 0.0
    assert rows[1].price_change_percent_24h == pytest.approx(1.0)
    assert rows[7].price_change_percent_7d == pytest.approx(7.0)
    # Midnight-aligned days: both ends of the frame count, so 8 and 31 points.
    assert rows[39].avg_price_7d == pytest.approx(sum(range(132, 140)) / 8)
    assert rows[39].avg_price_30d == pytest.approx(sum(range(109, 140)) / 31)
    assert rows[0].date == dt.datetime(2025, 3, 1)


def test_off_midnight_row_covers_one_day_less(prices):
    rows = _days("Bitcoin", "BTC", range(1, 11))
    rows.append(("Bitcoin", "BTC", "2025-03-11T12:47:50.520Z", 11.0))
    last = _by_date(price_features(prices(*rows)), "Bitcoin")[-1]
    assert last.avg_price_7d == pytest.approx(sum(range(5, 12)) / 7)


def test_changes_go_by_rows_not_days(prices):
    rows = _days("A", "A", [10, 20])
    rows.append(("A", "A", "2025-06-01 00:00:00", 40.0))
    assert _by_date(price_features(prices(*rows)), "A")[-1].price_change_percent_24h == 100.0


def test_one_row_series(prices):
    row = price_features(prices(("A", "USDC", "2025-03-01 00:00:00", 2.0))).first()
    assert (row.price_change_percent_24h, row.avg_price_7d, row.segment) == (0.0, 2.0, "stablecoin")


def test_symbol_case(prices):
    rows = prices(("Tether", "usdt", "2025-03-01 00:00:00", 1.0))
    assert price_features(rows).first().segment == "volatile"
    assert price_features(rows, normalize_symbol=True).first().segment == "stablecoin"


def test_bad_date_does_not_stop_the_job(prices):
    rows = prices(("A", "A", "not a date", 1.0), ("A", "A", "2025-03-01 00:00:00", 2.0))
    assert price_features(rows).count() == 2


def _rounded(df):
    columns = [
        F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ]
    return sorted(map(str, df.select(*columns).collect()))


def test_hot_cold_and_mixed_paths_agree(prices):
    rng = random.Random(3)
    rows = []
    for asset, n in (("hot", 60), ("warm", 12), ("cold", 3), (None, 40)):
        for _ in range(n):
            day = dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(50))
            time = f"{day} {rng.randrange(24):02}:{rng.randrange(60):02}:00"
            rows.append((asset, rng.choice(["X", "USDT"]), time, rng.uniform(1, 50)))
    rows += rows[::7]
    plain = price_features(prices(*rows))
    assert plain.filter(F.col("cryptocurrency").isNull()).count() > 0
    for options in ({"slice_rows": 20}, {"slice_rows": 2}):
        assert _rounded(price_features(prices(*rows), **options)) == _rounded(plain)


def test_input_order_does_not_matter(prices):
    rows = _days("A", "A", range(1, 12)) + _days("A", "B", range(21, 32))
    rows += [(*r[:3], r[3] + 0.5) for r in rows[::3]]
    expected = _rounded(price_features(prices(*rows)))
    for seed in range(2):
        shuffled = random.Random(seed).sample(rows, len(rows))
        assert _rounded(price_features(prices(*shuffled).repartition(3))) == expected


def test_asset_filter_reaches_every_scan(spark, prices, tmp_path):
    prices(*_days("A", "A", range(5)), *_days("B", "B", range(5))).write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p")).filter(F.col("cryptocurrency") == "A")
    plan = price_features(rows)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans
    assert all("EqualTo(cryptocurrency,A)" in line for line in scans)


def test_planning_starts_no_job(spark, prices):
    rows = prices(*_days("A", "A", range(5)))
    spark.sparkContext.setJobGroup("planning", "planning")
    price_features(rows)
    found = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not list(found)


def test_segments_need_no_window(spark, prices):
    rows = segment_rows(prices(*_days("A", "A", range(5)), *_days("B", "USDT", range(5))))
    assert {r.segment for r in rows.collect()} == {"stablecoin", "volatile"}
    plan = segment_aggregates(rows)._jdf.queryExecution().executedPlan().toString()
    by_asset = [x for x in plan.split("\n") if "hashpartitioning(cryptocurrency#" in x]
    assert all("symbol#" in line for line in by_asset)


def test_asset_metrics(prices):
    rows = _days("Bitcoin", "BTC", [1, 2]) + _days("Ethereum", "ETH", [3]) + _days("X", "X", [4])
    metrics = asset_metrics(price_features(prices(*rows)), ["Bitcoin", "Ethereum"])
    assert metrics.columns == [
        "cryptocurrency",
        "date",
        "price_usd",
        "price_change_percent_24h",
        "avg_price_7d",
        "avg_price_30d",
    ]
    assert [(r.cryptocurrency, r.price_usd) for r in metrics.collect()] == [
        ("Bitcoin", 1.0),
        ("Ethereum", 3.0),
        ("Bitcoin", 2.0),
    ]
