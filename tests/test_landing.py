"""Rejected lines, dealt samples, several streams at once, deep pages and pairs."""

from __future__ import annotations

import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlens import sinks, sources, streaming
from marketlens.operators.pairs import pair_on_time
from marketlens.operators.quality import clean, drop_duplicate_keys
from marketlens.operators.selection import page, ranked_pages
from marketlens.plans import analytics, ingest
from marketlens.plans.features import price_features
from marketlens.schema import SNAPSHOT_COLUMNS
from marketlens.streaming.relay import drawn_rows

TAIL = "1.0,2.0,3.0,0.0,0.0,4.0,5.0"
GOOD = [f"Bitcoin,BTC,2025-03-21 00:00:00,{TAIL}", f"Bitcoin,BTC,,{TAIL}", f'"a,b",X,2025-03-22T10:00:00.5Z,{TAIL}']
BAD = {
    f"Bitcoin,BTC,yesterday,{TAIL}": "bad time",
    f"Ethereum,ETH,2025-02-30,{TAIL}": "bad time",
    "Ethereum,ETH": "malformed line",
    f"Ethereum,ETH,2025-03-21,x{TAIL}": "malformed line",
    f"Ethereum,ETH,2025-03-21,{TAIL},1": "malformed line",
}


@pytest.fixture
def folder(tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.csv").write_text("\n".join([",".join(SNAPSHOT_COLUMNS), *GOOD[:2], *list(BAD)[:2]]) + "\n")
    time.sleep(0.01)
    (lines / "b.csv").write_text("\n".join([GOOD[2], "", *list(BAD)[2:]]) + "\n")
    return str(lines)


def _landed(good, rejected):
    assert good.columns == SNAPSHOT_COLUMNS
    assert sorted(r.symbol for r in good.collect()) == ["BTC", "BTC", "X"]
    assert {r.line: r.reason for r in rejected.collect()} == BAD
    assert rejected.count() == len(BAD)
    assert all(Path(r.origin).suffix == ".csv" for r in rejected.collect())


def test_good_and_rejected_are_all_lines(spark, folder, tmp_path):
    _landed(*ingest.ingest_snapshots(spark, folder))
    landed = str(tmp_path / "landed")
    _landed(*ingest.land_lines(spark, folder, landed))
    plan = sinks.read_accepted(spark, landed)._jdf.queryExecution().executedPlan().toString()
    assert "accepted#" in plan.split("PartitionFilters")[1]


def test_a_stream_keeps_rejects_and_goes_on(spark, folder, tmp_path):
    landed, state = str(tmp_path / "landed"), str(tmp_path / "state")
    checked = sources.checked_lines(streaming.spool_lines(spark, folder, files_per_batch=1))
    for _ in range(2):  # a second run finds nothing new
        sinks.stream_checked(checked, landed, state, available_only=True).awaitTermination()
        _landed(sinks.read_accepted(spark, landed), sinks.read_rejected(spark, landed))


def test_order_of_cleaning_shows_on_dirty_rows(spark):
    rows = [(1, 1, 5.0), (1, 2, None), (2, 1, None), (2, 2, 5.0), (3, 1, -5.0), (3, 2, 5.0), (4, 1, 5.0)]
    df = spark.createDataFrame(rows, "key int, copy int, price double")
    valid = F.col("price") > 0
    right = {r["key"] for r in clean(df, ["key"], ["price"], valid).collect()}
    assert right == {1, 4}  # keys whose kept copy is bad are gone
    swapped = drop_duplicate_keys(df.na.drop(subset=["price"]).filter(valid), ["key"])
    assert {r["key"] for r in swapped.collect()} == {1, 2, 3, 4}
    half = drop_duplicate_keys(df.na.drop(subset=["price"]), ["key"]).filter(valid)
    assert {r["key"] for r in half.collect()} == {1, 2, 4}


def test_repeats_are_dropped_over_a_restart(spark, tmp_path):
    spool, out, state = (str(tmp_path / n) for n in ("spool", "out", "state"))
    schema = "id int, at timestamp"

    def send(*rows):
        spark.createDataFrame([(i, t) for i, t in rows], "id int, at string").select(
            "id", F.col("at").cast("timestamp").alias("at")
        ).coalesce(1).write.mode("append").parquet(spool)

    def run():
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(spool)
        once = streaming.without_repeats(rows, ["id"], "1 hour", "at")
        return Counter(r["id"] for r in streaming.run_available(once, out, state).collect())

    send((1, "2025-01-01 10:00:00"), (1, "2025-01-01 10:00:00"), (2, "2025-01-01 10:30:00"))
    assert run() == {1: 1, 2: 1}
    send((2, "2025-01-01 10:30:00"), (3, "2025-01-01 09:45:00"))  # a repeat, and one late in bounds
    assert run() == {1: 1, 2: 1, 3: 1}
    send((4, "2025-01-02 10:00:00"))
    run()
    send((5, "2025-01-01 11:00:00"), (1, "2025-01-01 10:00:00"))  # far too late
    assert run() == {1: 1, 2: 1, 3: 1, 4: 1}


def test_batches_are_drawn_from_few_folders(spark, tmp_path):
    table = spark.range(4000).select("id", (F.col("id") % 7).cast("string").alias("name"))
    draws = streaming.deal(table, str(tmp_path / "dealt"), "id", seed=3, digits=1)
    assert sum(draws.counts.values()) == 4000 and len(draws.counts) == 16
    seen = Counter()
    for batch in range(6):
        rows = drawn_rows(spark, draws, 100, batch, "id", seed=3)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "_draw#" in plan.split("PartitionFilters")[1]
        ids = [r["id"] for r in rows.collect()]
        assert len(set(ids)) == 100
        assert ids == [r["id"] for r in drawn_rows(spark, draws, 100, batch, "id", seed=3).collect()]
        seen.update(ids)
    assert len(seen) > 300
    assert len(draws.folders(100, 0, 3)) == 1 and len(draws.folders(4000, 0, 3)) == 16
    # More rows than there are: all of them.
    assert drawn_rows(spark, draws, 10_000, 0, "id").count() == 4000
    empty = streaming.deal(table.limit(0), str(tmp_path / "none"), "id")
    assert drawn_rows(spark, empty, 10, 0, "id").count() == 0


def test_spooler_repeats_no_batch_after_a_restart(spark, tmp_path):
    table = spark.range(500)
    draws = streaming.deal(table, str(tmp_path / "dealt"), "id", digits=1)
    due, out, state = (str(tmp_path / n) for n in ("due", "out", "state"))

    def run():
        ticks = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(due)
        streaming.spool_draws(ticks, draws, out, state, "id", 20, every=None).awaitTermination()
        return {p.name: p.stat().st_mtime_ns for p in Path(out).glob("batch=*/*.txt")}

    for _ in range(2):
        spark.range(1).coalesce(1).write.mode("append").parquet(due)
    before = run()
    assert {p.parent.name for p in Path(out).glob("batch=*/*.txt")} == {"batch=0", "batch=1"}
    spark.range(1).coalesce(1).write.mode("append").parquet(due)
    after = run()
    assert before.items() <= after.items()
    rows = spark.read.schema("value string, batch int").text(out).groupBy("batch").count()
    assert {r["batch"]: r["count"] for r in rows.collect()} == {0: 20, 1: 20, 2: 20}


def test_one_failed_stream_does_not_hide_the_others(spark, tmp_path):
    spool = str(tmp_path / "spool")
    for i in range(3):
        spark.range(i * 10, i * 10 + 5 + i).coalesce(1).write.mode("append").parquet(spool)

    def start(name, make):
        rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(spool)
        out, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        return streaming.write_parquet(make(rows), out, state)

    fails = F.when(F.col("id") >= 10, F.raise_error(F.lit("no good")).cast("long")).otherwise(F.col("id"))
    queries = {
        "good": start("good", lambda r: r),
        "bad": start("bad", lambda r: r.withColumn("id", fails)),
    }
    seen = streaming.run_together(queries, timeout=120)
    assert not any(q.isActive for q in queries.values())
    assert list(seen.errors) == ["bad"] and "no good" in seen.errors["bad"]
    assert {b: n for (name, b), n in seen.rows.items() if name == "good"} == {0: 5, 1: 6, 2: 7}
    assert seen.rows["bad", 0] == 5
    assert spark.read.parquet(str(tmp_path / "good")).count() == 18


def test_streams_stop_when_time_is_over(spark, tmp_path):
    spool = str(tmp_path / "spool")
    spark.range(4).coalesce(1).write.parquet(spool)
    rows = spark.readStream.schema("id long").parquet(spool)
    query = streaming.write_parquet(rows, str(tmp_path / "out"), str(tmp_path / "state"))
    seen = streaming.run_together({"q": query}, timeout=0.5)
    assert not query.isActive and seen.rows == {("q", 0): 4} and not seen.errors


@pytest.mark.parametrize("ranges", [1, 7])
def test_deep_pages_equal_plain_ones(spark, tmp_path, ranges):
    rng = random.Random(4)
    rows = [(i, rng.choice([1.0, 2.0, None, 3.0])) for i in range(230)]
    df = spark.createDataFrame(rows, "id int, price double").repartition(3)
    order = [F.desc_nulls_last("price"), F.col("id").asc()]
    pages = ranked_pages(df, order, str(tmp_path / "pages"), ranges)
    for number in (1, 2, 9, 23, 24):
        want = [r["id"] for r in page(df, order, number, 10).collect()]
        got = pages.page(number, 10).orderBy("rank").collect()
        assert [r["id"] for r in got] == want
        assert [r["rank"] for r in got] == list(range(number * 10 - 9, number * 10 - 9 + len(want)))
    plan = pages.page(20, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan
    assert pages.page(99, 10).count() == 0


def test_pairs_keep_every_combination(spark):
    rows = [("A", 1, 1.0), ("A", 1, 2.0), ("B", 1, 5.0), ("B", 1, None), ("A", 2, 3.0), ("B", 3, 4.0)]
    rows += [("A", None, 1.0), ("B", None, 1.0), ("C", 1, 9.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    pairs = pair_on_time(df, "k", "t", "v", "A", "B", ("a", "b"))
    a, b = (df.filter(F.col("k") == k).select("t", F.col("v").alias(n)) for k, n in (("A", "a"), ("B", "b")))
    assert Counter(map(tuple, pairs.collect())) == Counter(map(tuple, a.join(b, "t").collect()))
    assert pairs.count() == 4
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("ExistingRDD") + plan.count("LogicalRDD") == 1


def test_leaders_are_found_before_the_windows(spark, prices):
    rows = [(f"A{a}", "X", f"2025-03-{d:02} 00:00:00", float((a * 7 + d * d) % 11 + 1), float(a % 6)) for a in range(12) for d in range(1, 20)]
    raw = prices(*rows)
    got = analytics.leader_anomalies(raw, k=3)
    want = analytics.top_asset_anomalies(price_features(raw), k=3)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # No window but those of the leaders' rows stands above a join with all rows.
    assert plan.index("LeftSemi") > plan.index("Window")
