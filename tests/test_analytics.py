from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.operators.selection import drop_keys, page, sample_rows
from marketlens.operators import pairs
from marketlens.plans import analytics

FEATURES = (
    "cryptocurrency string, date timestamp, price_usd double, market_cap double, "
    "volume_24h double, price_change_percent_24h double, price_change_percent_7d double, "
    "prev_price_7d double, segment string"
)


@pytest.fixture
def features(spark):
    def at(day, hour=0):
        return dt.datetime(2025, 4, day, hour)

    v, s = "volatile", "stablecoin"
    return spark.createDataFrame(
        [
            ("Bitcoin", at(1), 100.0, 900.0, 10.0, 0.0, 0.0, None, v),
            ("Bitcoin", at(2), 104.0, 910.0, 20.0, 4.0, 2.0, 90.0, v),
            ("Bitcoin", at(3, 12), 100.0, 905.0, 30.0, -3.0, 4.0, 90.0, v),
            ("Ethereum", at(1), 10.0, 500.0, 40.0, 1.0, 0.0, None, v),
            ("Ethereum", at(2), 11.0, 510.0, 50.0, None, -8.0, 11.5, v),
            ("Ethereum", at(3), 12.0, 505.0, 60.0, 2.0, 8.0, 11.5, v),
            ("Tether", at(1), 1.0, 300.0, 70.0, 0.5, 0.0, None, s),
            ("Tether", at(2), 1.0, 306.0, 80.0, 3.5, 0.0, None, s),
            ("Tether", at(3), 1.0, 294.0, 90.0, 0.0, 0.0, None, s),
        ],
        FEATURES,
    )


def test_segment_aggregates_by_grain(features):
    exact = analytics.segment_aggregates(features)
    assert exact.columns == ["segment", "date", "avg_price", "avg_market_cap", "avg_volume_24h"]
    assert exact.count() == 7
    daily = analytics.segment_aggregates(features, "day").filter("segment = 'volatile'")
    assert [r.avg_price for r in daily.orderBy("date").collect()] == [55.0, 57.5, 56.0]
    with pytest.raises(ValueError):
        analytics.segment_aggregates(features, "week")


def test_segment_volatility_ascending(features):
    rows = analytics.segment_volatility(features).collect()
    assert [r.segment for r in rows] == ["stablecoin", "volatile"]
    assert [r[1] for r in rows] == [pytest.approx(4 / 3), 2.0]


def test_asset_volatility_forms(features):
    rows = analytics.asset_volatility(features).collect()
    assert [r.cryptocurrency for r in rows] == ["Bitcoin", "Ethereum", "Tether"]
    ranged = analytics.asset_volatility(
        features, ["Bitcoin"], "2025-04-01", "2025-04-03", digits=2
    ).collect()
    # The bound stops at midnight, so the noon row of the 3rd is out.
    assert [tuple(r) for r in ranged] == [("Bitcoin", 2.0)]


def test_correlations(spark, features):
    signed = analytics.volume_change_correlation(features).first()[0]
    absolute = analytics.volume_change_correlation(features, signed=False).first()[0]
    assert signed != absolute
    frame = features.filter("segment = 'volatile'").toPandas()
    assert signed == pytest.approx(frame["volume_24h"].corr(frame["price_change_percent_24h"]))
    assert analytics.volume_change_correlation(features.limit(1)).first()[0] is None


def test_volume_split_and_uplift(features):
    split = analytics.anomaly_volume_split(features).first()
    assert tuple(split) == (25.0, pytest.approx(110 / 3))
    uplift = analytics.anomaly_volume_uplift(features).first()[0]
    assert uplift == pytest.approx((25 / (110 / 3) - 1) * 100)
    none = analytics.anomaly_volume_split(features, threshold=50).first()
    assert none.avg_volume_anomalies is None


def test_each_row_is_on_at_most_one_side(features):
    from marketlens.functions import is_anomaly, is_normal

    change = F.col("price_change_percent_24h")
    assert features.filter(is_anomaly(change) & is_normal(change)).isEmpty()
    assert features.filter(is_anomaly(change) | is_normal(change)).count() == 8


def test_price_pair_needs_equal_times(features):
    pairs = analytics.price_pair(features)
    assert pairs.columns == ["date", "bitcoin_price", "ethereum_price"]
    assert sorted(tuple(r)[1:] for r in pairs.collect()) == [(100.0, 10.0), (104.0, 11.0)]
    assert analytics.price_pair_correlation(features).first()[0] == pytest.approx(1.0)


def test_top_asset_anomalies(features):
    rows = analytics.top_asset_anomalies(features, k=2).collect()
    assert {(r.cryptocurrency, r.price_change_percent_24h) for r in rows} == {
        ("Bitcoin", 4.0),
        ("Bitcoin", -3.0),
    }
    assert analytics.top_asset_anomalies(features, k=3).count() == 3


def test_series(features):
    rows = analytics.price_series(features, ["Bitcoin", "Ethereum"], end="2025-04-02").collect()
    assert [(r.cryptocurrency, r.price_usd) for r in rows] == [
        ("Bitcoin", 100.0),
        ("Ethereum", 10.0),
        ("Bitcoin", 104.0),
        ("Ethereum", 11.0),
    ]
    segments = analytics.segment_aggregates(features)
    kept = analytics.segment_series(segments, "avg_market_cap", [("volatile", "2025-04-03")])
    assert [(r.segment, r.date.day) for r in kept.collect()] == [
        ("stablecoin", 1),
        ("volatile", 1),
        ("stablecoin", 2),
        ("volatile", 2),
        ("stablecoin", 3),
    ]
    assert sorted(r[0] for r in analytics.segment_names(segments).collect()) == [
        "stablecoin",
        "volatile",
    ]


def test_weekly_trend(features):
    by_asset = {r[0]: r[1] for r in analytics.weekly_trend(features).collect()}
    assert by_asset == {"Bitcoin": 2.0, "Ethereum": 0.0, "Tether": 0.0}
    skipped = {r[0]: r[1] for r in analytics.weekly_trend(features, skip_first=True).collect()}
    assert skipped == {"Bitcoin": 3.0, "Ethereum": 0.0, "Tether": None}


def test_cap_stability(features):
    row = analytics.segment_cap_stability(features).filter("segment = 'stablecoin'").first()
    assert row.mean_cap == 300.0
    assert row.max_rise_percent == pytest.approx(2.0)
    assert row.max_fall_percent == pytest.approx(-2.0)
    assert row.max_spread_percent == pytest.approx(2.0)


def test_pages_and_samples(spark):
    df = spark.range(100)
    assert [r.id for r in page(df, [F.desc("id")], 2, 10).collect()] == list(range(89, 79, -1))
    assert page(df, ["id"], 11, 10).isEmpty()
    drawn = [r.id for r in sample_rows(df, 20, "id", seed=1).collect()]
    assert len(set(drawn)) == 20
    assert drawn != sorted(drawn)
    assert sample_rows(df, 500, "id", seed=1).count() == 100
    assert drawn == [r.id for r in sample_rows(df.repartition(7), 20, "id", seed=1).collect()]
    assert drawn != [r.id for r in sample_rows(df, 20, "id", seed=2).collect()]
    assert "TakeOrderedAndProject" in sample_rows(df, 5, "id")._jdf.queryExecution().toString()


def test_drop_keys(spark):
    left = spark.range(5)
    assert sorted(r.id for r in drop_keys(left, spark.range(2), "id").collect()) == [2, 3, 4]


def test_pairs_of_crowded_times_are_dealt_in_blocks(spark, monkeypatch):
    """Nulls, copies, and times with more rows than a block on one side or both."""
    monkeypatch.setattr(pairs, "BLOCK_ROWS", 3)
    rows = [("a", t, float(i) if i % 5 else None) for t, n in ((1, 10), (2, 1), (3, 7), (4, 2)) for i in range(n)]
    rows += [("b", t, 0.5 * (i // 2)) for t, n in ((1, 8), (2, 9), (3, 1), (5, 2)) for i in range(n)]
    rows += [("c", 1, 1.0), ("a", None, 1.0), ("b", None, 2.0), (None, 1, 3.0)]
    done = pairs.pair_on_time(spark.createDataFrame(rows, "k string, t int, v double"), "k", "t", "v", "a", "b", ("x", "y"))
    want = [(t, v, w) for k, t, v in rows for m, u, w in rows if (k, m) == ("a", "b") and t == u and t is not None]
    assert sorted(map(tuple, done.collect()), key=repr) == sorted(want, key=repr)
    # Few bytes, many combinations: they are not merged into one task.
    assert done.select(F.spark_partition_id().alias("p")).distinct().count() > 1
