"""The batch job, and the feature table grown day by day."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlens.plans import batch, incremental
from marketlens.plans.analytics import segment_aggregates
from marketlens.plans.features import price_features
from marketlens.schema import ASSET, FEATURE_COLUMNS, TIME


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns or FEATURE_COLUMNS).collect()), key=repr)


def _ticks(days, seed=1, assets=("Bitcoin", "17", "a/b=c", None)):
    """Ticks at any time of day, with gaps, repeated keys and bad prices."""
    rng, start = random.Random(seed), dt.datetime(2025, 1, 1)
    rows = []
    for day in range(days):
        for asset in assets:
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                at = start + dt.timedelta(days=day, seconds=rng.randrange(86_400))
                row = (asset, rng.choice(["BTC", "USDC"]), str(at), rng.choice([-1.0, 1.5, 2.0, 4.0, 8.0]))
                rows += [row] * rng.choice([1, 1, 2])
    return rows


def test_tables_are_written_once_and_read_back(spark, prices, tmp_path):
    raw = prices(*_ticks(40))
    tables = batch.run_batch(raw, str(tmp_path))
    features = batch.read_features(spark, tables.features)
    assert features.columns == FEATURE_COLUMNS
    want = price_features(raw)
    assert _rows(features) == _rows(want)
    # Counted while the clean rows were written, without a job of its own.
    assert tables.rows == want.count() == spark.read.parquet(tables.cleaned).count()
    segments = batch.read_segments(spark, tables.segments)
    means = segment_aggregates(want)
    assert _rows(segments, *means.columns) == _rows(means, *means.columns)


def test_reads_of_some_assets_skip_other_folders(spark, prices, tmp_path):
    tables = batch.run_batch(prices(*_ticks(20)), str(tmp_path))
    some = batch.read_features(spark, tables.features, ["Bitcoin", "17"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cryptocurrency" in plan
    read = {r[0] for r in some.select(F.input_file_name()).distinct().collect()}
    assert {f.split("cryptocurrency=")[1].split("/")[0] for f in read} == {"Bitcoin", "17"}
    assert {r[ASSET] for r in some.select(ASSET).distinct().collect()} == {"Bitcoin", "17"}


def test_sorted_files_for_many_assets(spark, prices, tmp_path):
    raw = prices(*_ticks(20))
    tables = batch.run_batch(raw, str(tmp_path), by_asset=False)
    assert _rows(batch.read_features(spark, tables.features)) == _rows(price_features(raw))
    assert not list(tmp_path.glob("features/cryptocurrency=*"))


def test_unfinished_tables_are_refused(spark, prices, tmp_path):
    tables = batch.run_batch(prices(*_ticks(3)), str(tmp_path))
    (tmp_path / "features" / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError):
        batch.read_features(spark, tables.features)


def _between(df, first, last):
    return df.filter((F.col(TIME) >= str(first)) & (F.col(TIME) < str(last)))


def test_grown_table_equals_the_one_built_at_once(spark, prices, tmp_path):
    rows = _ticks(80, seed=3)
    # Assets that pause for longer than any mean reaches, or begin late.
    rows += [("rare", "R", f"2025-01-0{d} 10:00:00", float(d)) for d in range(1, 9)]
    rows += [("rare", "R", f"2025-03-1{d} 09:00:00", float(d + 10)) for d in range(6)]
    rows += [("late", "L", "2025-03-10 00:00:00", 3.0), (None, "N", None, 1.0)]
    raw, path = prices(*rows), str(tmp_path)
    ends = ["2025-01-01", "2025-02-20", "2025-02-21", "2025-03-10", "2025-03-11", "2026-01-01"]
    for first, last in zip(ends, ends[1:], strict=False):
        for _ in range(2 if first == "2025-02-21" else 1):  # a load may be repeated
            incremental.grow(_between(raw, first, last), path)
    got = incremental.read_grown(spark, path)
    assert _rows(got) == _rows(price_features(raw.filter(F.col(TIME).isNotNull())))
    assert incremental.undated(raw).count() == 1
    assert incremental.grow(raw.limit(0), path) == incremental.Load(None, None)


def test_a_load_reads_its_prices_once(spark, prices, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch_ in batches:
            seen.add(batch_.num_rows)
            yield batch_

    raw = prices(*_ticks(12, seed=4))
    given = raw.mapInArrow(passed, raw.schema)
    incremental.grow(given, str(tmp_path))
    assert seen.value == raw.count()
    assert _rows(incremental.read_grown(spark, str(tmp_path))) == _rows(price_features(raw))


def test_a_load_writes_only_its_own_days(spark, prices, tmp_path):
    raw, path = prices(*_ticks(40, seed=5)), str(tmp_path)
    incremental.grow(_between(raw, "2025-01-01", "2025-02-05"), path)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("features/day=*/*.parquet")}
    load = incremental.grow(_between(raw, "2025-02-05", "2025-02-07"), path)
    assert (load.first, load.last) == ("2025-02-05", "2025-02-06")
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("features/day=*/*.parquet")}
    assert {p: after[p] for p in before} == before
    assert {p.parent.name for p in after.keys() - before.keys()} == {"day=2025-02-05", "day=2025-02-06"}


def test_days_out_of_order_are_refused(spark, prices, tmp_path):
    raw, path = prices(*_ticks(12, seed=6)), str(tmp_path)
    incremental.grow(_between(raw, "2025-01-01", "2025-01-06"), path)
    incremental.grow(_between(raw, "2025-01-06", "2025-01-09"), path)
    with pytest.raises(ValueError, match="given again"):
        incremental.grow(_between(raw, "2025-01-03", "2025-01-04"), path)
    # All days from there on together are fine.
    incremental.grow(_between(raw, "2025-01-06", "2025-01-12"), path)
    want = price_features(_between(raw, "2025-01-01", "2025-01-12"))
    assert _rows(incremental.read_grown(spark, path)) == _rows(want)


def test_a_load_that_failed_must_be_repeated(spark, prices, tmp_path, monkeypatch):
    raw, path = prices(*_ticks(12, seed=7)), str(tmp_path)
    incremental.grow(_between(raw, "2025-01-01", "2025-01-05"), path)
    second = _between(raw, "2025-01-05", "2025-01-07")
    tails = incremental._tails
    monkeypatch.setattr(incremental, "_tails", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        incremental.grow(second, path)
    monkeypatch.setattr(incremental, "_tails", tails)
    with pytest.raises(ValueError, match="did not finish"):
        incremental.grow(_between(raw, "2025-01-07", "2025-01-09"), path)
    incremental.grow(second, path)
    incremental.grow(_between(raw, "2025-01-07", "2025-01-13"), path)
    assert _rows(incremental.read_grown(spark, path)) == _rows(price_features(raw))
