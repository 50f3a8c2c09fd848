"""The feature table: cleaned prices with changes, segment and trailing means."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import change_or_zero, segment_of, to_instant
from ..operators.quality import clean
from ..operators.slices import SLICE_ROWS
from ..operators.windows import sized_windows
from ..schema import (
    ASSET,
    CAP,
    CHANGE_1,
    CHANGE_7,
    LAG_ROWS,
    PREV_1,
    PREV_7,
    PRICE,
    SEGMENT,
    SNAPSHOT_KEY,
    STABLE_SYMBOLS,
    SYMBOL,
    TIME,
    TRAILING_DAYS,
    VOLUME,
)

# Order within an asset. The symbol only breaks ties, so results do not depend on input order.
_ORDER = [TIME, SYMBOL]


def clean_prices(prices: DataFrame) -> DataFrame:
    """One row per (asset, symbol, time); price, cap and volume present; price > 0, cap >= 0."""
    return clean(
        prices.withColumn(TIME, to_instant(F.col(TIME))),
        SNAPSHOT_KEY,
        [PRICE, CAP, VOLUME],
        (F.col(PRICE) > 0) & (F.col(CAP) >= 0),
    )


def segment_rows(
    prices: DataFrame,
    stable_symbols: Iterable[str] = STABLE_SYMBOLS,
    normalize_symbol: bool = False,
) -> DataFrame:
    """Cleaned price rows with their segment: all that segment questions without changes need."""
    segment = segment_of(F.col(SYMBOL), stable_symbols, normalize_symbol)
    return clean_prices(prices).withColumn(SEGMENT, segment)


def price_features(
    prices: DataFrame,
    stable_symbols: Iterable[str] = STABLE_SYMBOLS,
    normalize_symbol: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Price rows to the feature table: changes replaced, and five columns added.

    Slices follow the rows before de-duplication, which are cheaper to count.
    """
    timed = prices.withColumn(TIME, to_instant(F.col(TIME)))
    return features_of(clean_prices(timed), stable_symbols, normalize_symbol, slice_rows, timed)


def features_of(
    cleaned: DataFrame,
    stable_symbols: Iterable[str] = STABLE_SYMBOLS,
    normalize_symbol: bool = False,
    slice_rows: int = SLICE_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The feature table of rows that are clean already. ``counted``: see ``sized_windows``."""
    windowed = sized_windows(
        cleaned, ASSET, TIME, _ORDER, PRICE, LAG_ROWS, TRAILING_DAYS, slice_rows, counted
    )
    price = F.col(PRICE)
    added = [CHANGE_1, CHANGE_7, PREV_1, PREV_7, SEGMENT, *TRAILING_DAYS]
    return windowed.withColumns(
        {
            CHANGE_1: change_or_zero(price, F.col(PREV_1)),
            CHANGE_7: change_or_zero(price, F.col(PREV_7)),
            SEGMENT: segment_of(F.col(SYMBOL), stable_symbols, normalize_symbol),
        }
    ).select(*cleaned.columns, *[c for c in added if c not in cleaned.columns])


def asset_metrics(features: DataFrame, assets: Iterable[str]) -> DataFrame:
    """Price, change and trailing means of some assets in date order."""
    return (
        features.filter(F.col(ASSET).isin(*assets))
        .select(ASSET, TIME, PRICE, CHANGE_1, *TRAILING_DAYS)
        .orderBy(TIME, ASSET)
    )
