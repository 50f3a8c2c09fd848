"""A stream gives what the same rows give as a batch."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlens import streaming
from marketlens.schema import SNAPSHOT_COLUMNS
from marketlens.streaming.relay import kafka_records, write_sample
from marketlens.streaming.sources import kafka_options

LINES = [
    "Bitcoin,BTC,2025-03-21 00:00:00,1.5,2.0,3.0,3.0,0.0,4.0,5.0",
    "Bitcoin,btc,2025-04-20T12:47:50.520Z,1.5,2.0,3.0,-3.5,0.0,4.0,5.0",
    "Ethereum,ETH,2025-03-21 00:00:00,1.5,2.0,3.0,2.9,0.0,4.0,5.0",
    "Ethereum,ETH,2025-03-22 00:00:00,1.5,2.0,3.0,oops,0.0,4.0,5.0",
    "Ethereum,ETH,junk,1.5,2.0,3.0,9.0,0.0,4.0,5.0",
]


@pytest.fixture
def spool(tmp_path):
    folder = tmp_path / "spool"
    folder.mkdir()
    for i, line in enumerate(LINES):
        (folder / f"part_{i}.csv").write_text(line + "\n" + LINES[0] + "\n")
    (folder / "notes.txt").write_text("not a line\n")
    return folder


def test_stream_equals_batch(spark, spool, tmp_path):
    lines = streaming.spool_lines(spark, str(spool), files_per_batch=2)
    found = streaming.run_available(
        streaming.stream_anomalies(lines), str(tmp_path / "out"), str(tmp_path / "state")
    )
    batch = streaming.stream_anomalies(spark.read.text(str(spool / "*.csv")))
    assert found.columns == batch.columns == SNAPSHOT_COLUMNS
    assert sorted(map(str, found.collect())) == sorted(map(str, batch.collect()))
    assert found.count() == 8
    assert found.filter("date IS NULL").count() == 1


def test_restart_reads_only_what_is_new(spark, spool, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        lines = streaming.spool_lines(spark, str(spool))
        return streaming.run_available(streaming.stream_anomalies(lines), out, state).count()

    assert run() == 8
    assert run() == 8
    (spool / "late.csv").write_text(LINES[1] + "\n")
    assert run() == 9


def test_bytes_and_threshold(spark):
    lines = spark.createDataFrame([(x.encode(),) for x in LINES], "value binary")
    assert streaming.stream_anomalies(lines, threshold=5).count() == 1
    bad = streaming.parse_stream(lines).filter("_corrupt_record IS NOT NULL")
    assert [r._corrupt_record for r in bad.collect()] == [LINES[3]]


def test_repeats_can_be_dropped(spark, spool, tmp_path):
    lines = streaming.spool_lines(spark, str(spool))
    rows = streaming.without_repeats(streaming.stream_anomalies(lines))
    out = streaming.run_available(rows, str(tmp_path / "out"), str(tmp_path / "state"))
    assert out.filter("symbol = 'BTC'").count() == 1


def test_relay_copies_each_line_once(spark, spool, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        lines = streaming.spool_lines(spark, str(spool), files_per_batch=1)
        streaming.relay_to_lines(lines, out, state, once=True).awaitTermination()
    copied = [r.value for r in spark.read.text(out).collect()]
    assert sorted(copied) == sorted([*LINES, *[LINES[0]] * len(LINES)])


def test_read_files_can_be_deleted(spark, spool, tmp_path):
    def relay():
        lines = streaming.spool_lines(spark, str(spool), delete_read=True)
        streaming.relay_to_lines(
            lines, str(tmp_path / "out"), str(tmp_path / "state"), once=True
        ).awaitTermination()

    relay()
    (spool / "late.csv").write_text(LINES[1] + "\n")
    relay()
    # Files of a batch are removed once a later batch begins.
    deadline = time.time() + 20
    while len(list(spool.glob("part_*.csv"))) > 0 and time.time() < deadline:
        time.sleep(0.2)
    assert not list(spool.glob("part_*.csv"))
    assert spark.read.text(str(tmp_path / "out")).count() == 11


def test_sample_batches_are_replaced_not_repeated(spark, tmp_path):
    table = spark.range(500).select("id", F.lit("x").alias("name"))
    folder = str(tmp_path / "samples")
    for batch in (0, 1, 1):
        write_sample(table, folder, 100, batch, "id", seed=5)
    lines = spark.read.option("recursiveFileLookup", True).text(folder)
    assert lines.count() == 200
    assert lines.filter(F.col("value").endswith(",x")).count() == 200


def test_spooler_runs_on_its_own(spark, tmp_path):
    folder = tmp_path / "samples"
    query = streaming.spool_samples(
        spark, lambda: spark.range(50), str(folder), str(tmp_path / "state"), "id", 10, "1 second", 3
    )
    deadline = time.time() + 60
    while not list(folder.glob("batch=*/_SUCCESS")) and time.time() < deadline:
        time.sleep(0.2)
    query.stop()
    assert list(Path(folder).glob("batch=*/_SUCCESS"))


def test_console_and_waiting(spark, spool, tmp_path):
    spark.streams.resetTerminated()
    lines = streaming.spool_lines(spark, str(spool))
    query = streaming.write_console(streaming.stream_anomalies(lines), str(tmp_path / "state"))
    query.processAllAvailable()
    other = streaming.write_console(streaming.stream_anomalies(lines), str(tmp_path / "other"))
    assert streaming.await_all([query], timeout=1) is False
    assert not query.isActive
    assert other.isActive
    other.stop()
    assert streaming.await_all([other]) is True


def test_kafka_parts(spark):
    assert kafka_options("kafka:9092", "ticks") == {
        "kafka.bootstrap.servers": "kafka:9092",
        "subscribe": "ticks",
        "startingOffsets": "earliest",
    }
    lines = spark.createDataFrame([(LINES[0], "file:/spool/a.csv")], "value string, origin string")
    record = kafka_records(lines).first()
    assert record.value == LINES[0]
    assert record.headers[0].key == "file"
    assert bytes(record.headers[0].value) == b"file:/spool/a.csv"
