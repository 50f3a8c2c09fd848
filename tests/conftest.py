from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marketlens.schema import SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA  # noqa: E402
from marketlens.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def prices(spark):
    """Price rows from (asset, symbol, date, price[, cap, volume, change])."""

    def make(*rows):
        filled = []
        for row in rows:
            values = dict(zip(SNAPSHOT_COLUMNS, row, strict=False))
            for column in ("market_cap", "volume_24h"):
                values.setdefault(column, 1.0)
            filled.append(tuple(values.get(c, 0.0) for c in SNAPSHOT_COLUMNS))
        return spark.createDataFrame(filled, SNAPSHOT_SCHEMA)

    return make
