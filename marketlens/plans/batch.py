"""The batch job: feature table and segment table, written once and read back by those who ask."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import counted
from ..operators.slices import SLICE_ROWS
from ..schema import ASSET, FEATURE_COLUMNS, FEATURE_SCHEMA, SEGMENT, STABLE_SYMBOLS, TIME
from ..sinks.parquet import write_partitioned, write_plain
from ..sources.files import is_committed
from .analytics import segment_aggregates
from .features import clean_prices, features_of


@dataclass(frozen=True)
class Tables:
    """Where the job put its tables, and how many rows were clean."""

    cleaned: str
    features: str
    segments: str
    rows: int


def run_batch(
    prices: DataFrame,
    folder: str,
    stable_symbols: Iterable[str] = STABLE_SYMBOLS,
    normalize_symbol: bool = False,
    grain: str = "exact",
    by_asset: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> Tables:
    """Clean, write; add changes and means, write; average per segment, write.

    Every step reads what the one before wrote, so prices are read and de-duplicated once and a
    lost executor repeats its own step. The clean rows are counted while they are written. The
    feature table has a folder per asset, for reads of some assets; with ``by_asset=False``, for
    very many assets, its files are sorted by asset instead. The segment table has a folder per
    segment.
    """
    spark = prices.sparkSession
    tables = {name: f"{folder.rstrip('/')}/{name}" for name in ("cleaned", "features", "segments")}
    cleaned, seen = counted(clean_prices(prices), "cleaned")
    write_plain(cleaned, tables["cleaned"])
    features = features_of(
        spark.read.parquet(tables["cleaned"]), stable_symbols, normalize_symbol, slice_rows
    )
    if by_asset:
        write_partitioned(features, tables["features"], ASSET)
    else:
        ordered = features.hint("rebalance", ASSET).sortWithinPartitions(ASSET, TIME)
        write_plain(ordered, tables["features"])
    means = segment_aggregates(read_features(spark, tables["features"]), grain)
    write_partitioned(means, tables["segments"], SEGMENT)
    return Tables(**tables, rows=seen.get["row_count"])


def read_features(
    spark: SparkSession, path: str, assets: Iterable[str] | None = None
) -> DataFrame:
    """The feature table in its column order; of some assets, only their folders are read.

    The schema is given, as a folder's name does not tell whether an asset is text or a number.
    """
    if not is_committed(spark, path):
        raise FileNotFoundError(f"no _SUCCESS in {path}")
    table = spark.read.schema(FEATURE_SCHEMA).parquet(path).select(*FEATURE_COLUMNS)
    return table if assets is None else table.filter(F.col(ASSET).isin(*assets))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segment table, segment and time first."""
    if not is_committed(spark, path):
        raise FileNotFoundError(f"no _SUCCESS in {path}")
    table = spark.read.parquet(path)
    return table.select(SEGMENT, TIME, *[c for c in table.columns if c not in (SEGMENT, TIME)])
