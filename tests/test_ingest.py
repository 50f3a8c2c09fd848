from __future__ import annotations

import datetime as dt

import pytest

from marketlens.plans.ingest import (
    backfill_plan,
    history_rows,
    ingest_payloads,
    ingest_snapshots,
    market_rows,
)
from marketlens.plans.features import clean_prices
from marketlens.schema import SNAPSHOT_COLUMNS

HEADER = ",".join(SNAPSHOT_COLUMNS)
TAIL = "1.5,2.0,3.0,0.0,0.0,4.0,5.0"


def test_files_with_and_without_header(spark, tmp_path):
    daily = tmp_path / "daily"
    daily.mkdir()
    (daily / "one.csv").write_bytes(
        f"{HEADER}\r\nBitcoin,BTC,2025-03-21 00:00:00,{TAIL}\r\n".encode()
    )
    (daily / "two.csv").write_bytes(
        f"Bitcoin,btc,2025-04-20T12:47:50.520Z,{TAIL}\nEthereum,eth,2025-04-20,oops,1,1,1,1,1,1\n\n"
        f"Ethereum,eth\n".encode()
    )
    good, rejected = ingest_snapshots(spark, str(daily))
    assert good.columns == SNAPSHOT_COLUMNS
    assert sorted((r.symbol, r.circulating_supply) for r in good.collect()) == [
        ("BTC", 5.0),
        ("btc", 5.0),
    ]
    assert sorted(r.line for r in rejected.collect()) == [
        "Ethereum,eth",
        "Ethereum,eth,2025-04-20,oops,1,1,1,1,1,1",
    ]
    assert all(r.origin.endswith("two.csv") for r in rejected.collect())
    # A bad line stays rejected in a query that does not read its bad column.
    assert good.select("cryptocurrency").count() == 2
    times = sorted(r.date for r in clean_prices(good).collect())
    assert times == [dt.datetime(2025, 3, 21), dt.datetime(2025, 4, 20, 12, 47, 50, 520000)]


MARKET = (
    '[{"id":"bitcoin","name":"Bitcoin","symbol":"btc","total_supply":21.0,'
    '"circulating_supply":19},'
    '{"id":"ethereum","name":"Ethereum","symbol":"eth","total_supply":null},'
    '{"name":"No id","symbol":"x"}]'
)


def test_market_list(spark):
    raw = spark.createDataFrame([(MARKET,), ("busy",), ('{"error":1}',), (None,)], "payload string")
    rows = market_rows(raw).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("bitcoin", "Bitcoin", "BTC", 21.0, 19.0),
        ("ethereum", "Ethereum", "ETH", None, 0.0),
    ]


def test_history_defaults(spark):
    day = dt.date(2025, 3, 21)
    full = '{"market_data":{"current_price":{"usd":2.5},"market_cap":{"usd":7},"total_volume":{}}}'
    raw = spark.createDataFrame(
        [("a", day, full), ("b", day, "{}"), ("c", day, "timeout"), ("d", day, "[1]")],
        "id string, day date, payload string",
    )
    rows = {r.id: tuple(r)[2:] for r in history_rows(raw).collect()}
    assert rows == {"a": (2.5, 7.0, 0.0), "b": (0.0, 0.0, 0.0)}


def test_payloads_to_snapshot_rows(spark):
    markets = spark.createDataFrame([(MARKET,), (MARKET,)], "payload string")
    history = spark.createDataFrame(
        [("bitcoin", dt.date(2025, 3, 21), '{"market_data":{"current_price":{"usd":2.5}}}')],
        "id string, day date, payload string",
    )
    rows = ingest_payloads(markets, history)
    assert rows.columns == SNAPSHOT_COLUMNS
    assert tuple(rows.first()) == (
        "Bitcoin", "BTC", "2025-03-21 00:00:00", 2.5, 0.0, 0.0, 0.0, 0.0, 21.0, 19.0,
    )


def test_backfill_grains(spark):
    universe = spark.createDataFrame([("a",), ("b",)], "asset string")
    loaded = spark.createDataFrame(
        [("a", dt.date(2025, 4, 19)), ("a", dt.date(2025, 1, 1))], "asset string, day date"
    )
    by_day = backfill_plan(universe, loaded, "2025-04-20", days=3)
    assert sorted((r.asset, r.day.day) for r in by_day.collect()) == [
        ("a", 18), ("a", 20), ("b", 18), ("b", 20),
    ]
    by_asset = backfill_plan(universe, loaded, "2025-04-20", days=3, grain="asset")
    assert sorted((r.asset, r.day.day) for r in by_asset.collect()) == [
        ("a", 18), ("a", 20), ("b", 18), ("b", 19), ("b", 20),
    ]
    plan = by_asset._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        backfill_plan(universe, loaded, "2025-04-20", grain="hour")
