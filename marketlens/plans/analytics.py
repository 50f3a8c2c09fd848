"""Questions asked of the feature table and of the segment table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_anomaly, is_normal, percent_change
from ..operators.pairs import correlation, pair_on_time
from ..operators.selection import keep_keys, top_keys
from ..operators.slices import SLICE_ROWS
from ..schema import (
    ANOMALY_PERCENT,
    ASSET,
    CAP,
    CHANGE_1,
    CHANGE_7,
    PRICE,
    SEGMENT,
    STABLE_SYMBOLS,
    TIME,
    VOLATILE,
    VOLUME,
)
from .features import clean_prices, price_features

# Keys that are sent to all tasks at most.
MOST_SENT = 100_000


def segment_aggregates(features: DataFrame, grain: str = "exact") -> DataFrame:
    """Mean price, cap and volume per segment and time.

    ``grain="exact"`` groups by the timestamp itself, ``"day"`` by its day.
    """
    if grain not in ("exact", "day"):
        raise ValueError("grain is 'exact' or 'day'")
    time = F.col(TIME) if grain == "exact" else F.date_trunc("day", F.col(TIME))
    return features.groupBy(SEGMENT, time.alias(TIME)).agg(
        F.avg(PRICE).alias("avg_price"),
        F.avg(CAP).alias("avg_market_cap"),
        F.avg(VOLUME).alias("avg_volume_24h"),
    )


def segment_volatility(features: DataFrame) -> DataFrame:
    """Mean absolute change per segment, smallest first."""
    mean = F.avg(F.abs(CHANGE_1)).alias("avg_abs_price_change_percent")
    return features.groupBy(SEGMENT).agg(mean).orderBy("avg_abs_price_change_percent", SEGMENT)


def _between(features: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows in a closed range of times. A bound without clock time means midnight."""
    if start is not None:
        features = features.filter(F.col(TIME) >= F.lit(start).cast("timestamp"))
    if end is not None:
        features = features.filter(F.col(TIME) <= F.lit(end).cast("timestamp"))
    return features


def asset_volatility(
    features: DataFrame,
    assets: Iterable[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Mean absolute change per asset.

    Plain form: ``avg_volatility``, largest first. With ``digits``: ``avg_daily_volatility``,
    rounded, in no order. Both may be restricted to assets and to a closed range of times.
    """
    rows = _between(features, start, end)
    if assets is not None:
        rows = rows.filter(F.col(ASSET).isin(*assets))
    mean = F.avg(F.abs(CHANGE_1))
    if digits is not None:
        return rows.groupBy(ASSET).agg(F.round(mean, digits).alias("avg_daily_volatility"))
    by_asset = rows.groupBy(ASSET).agg(mean.alias("avg_volatility"))
    return by_asset.orderBy(F.desc("avg_volatility"), ASSET)


def volume_change_correlation(
    features: DataFrame, segment: str = VOLATILE, signed: bool = True
) -> DataFrame:
    """Correlation of volume with the change, or with its absolute value."""
    change = F.col(CHANGE_1) if signed else F.abs(CHANGE_1)
    rows = features.filter(F.col(SEGMENT) == segment).select(VOLUME, change.alias("_change"))
    return correlation(rows, VOLUME, "_change")


def _volume_means(segment_rows: DataFrame, threshold: float) -> tuple[Column, Column]:
    change, volume = F.col(CHANGE_1), F.col(VOLUME)
    return (
        F.avg(F.when(is_anomaly(change, threshold), volume)),
        F.avg(F.when(is_normal(change, threshold), volume)),
    )


def anomaly_volume_split(
    features: DataFrame, segment: str = VOLATILE, threshold: float = ANOMALY_PERCENT
) -> DataFrame:
    """Mean volume of anomalous and of normal rows of a segment, from one scan."""
    rows = features.filter(F.col(SEGMENT) == segment)
    anomalous, normal = _volume_means(rows, threshold)
    return rows.agg(
        anomalous.alias("avg_volume_anomalies"), normal.alias("avg_volume_normal")
    )


def anomaly_volume_uplift(
    features: DataFrame, segment: str = VOLATILE, threshold: float = ANOMALY_PERCENT
) -> DataFrame:
    """Percent by which mean volume is higher on anomalous rows than on normal ones."""
    return anomaly_volume_split(features, segment, threshold).select(
        percent_change(F.col("avg_volume_anomalies"), F.col("avg_volume_normal")).alias(
            "uplift_percent"
        )
    )


def price_pair(
    features: DataFrame,
    left: str = "Bitcoin",
    right: str = "Ethereum",
    names: tuple[str, str] = ("bitcoin_price", "ethereum_price"),
) -> DataFrame:
    """Prices of two assets at equal times."""
    return pair_on_time(features, ASSET, TIME, PRICE, left, right, names)


def price_pair_correlation(
    features: DataFrame, left: str = "Bitcoin", right: str = "Ethereum"
) -> DataFrame:
    """Correlation of two assets' prices over their common times."""
    return correlation(price_pair(features, left, right, ("_left", "_right")), "_left", "_right")


def top_asset_anomalies(
    features: DataFrame, k: int = 5, threshold: float = ANOMALY_PERCENT
) -> DataFrame:
    """Anomalous rows of the k assets with the largest mean cap."""
    leaders = _few(top_keys(features, ASSET, F.avg(CAP), k), k)
    return keep_keys(features.filter(is_anomaly(F.col(CHANGE_1), threshold)), leaders, ASSET)


def _few(keys: DataFrame, k: int) -> DataFrame:
    """At most k keys; sent to all tasks if k is small, else joined as Catalyst sees fit."""
    return F.broadcast(keys) if k <= MOST_SENT else keys


def leader_anomalies(
    prices: DataFrame,
    k: int = 5,
    threshold: float = ANOMALY_PERCENT,
    stable_symbols: Iterable[str] = STABLE_SYMBOLS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """As ``top_asset_anomalies``, straight from price rows: windows see the k assets alone.

    Leaders are told by clean rows, which needs no window. An asset's rows depend on no other
    asset, so the filter goes below cleaning and windows.
    """
    leaders = _few(top_keys(clean_prices(prices), ASSET, F.avg(CAP), k), k)
    theirs = keep_keys(prices, leaders, ASSET)
    features = price_features(theirs, stable_symbols, slice_rows=slice_rows)
    return features.filter(is_anomaly(F.col(CHANGE_1), threshold))


def price_series(
    features: DataFrame,
    assets: Iterable[str],
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Price and change of some assets in date order, for a chart."""
    return (
        _between(features, start, end)
        .filter(F.col(ASSET).isin(*assets))
        .select(ASSET, TIME, PRICE, CHANGE_1)
        .orderBy(TIME, ASSET)
    )


def segment_series(
    segments: DataFrame, measure: str, exclude: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """One measure of the segment table in date order, without the excluded (segment, day) pairs."""
    kept = segments
    for segment, day in exclude:
        on_day = F.to_date(TIME) == F.lit(day).cast("date")
        kept = kept.filter(~((F.col(SEGMENT) == segment) & on_day))
    return kept.select(SEGMENT, TIME, measure).orderBy(TIME, SEGMENT)


def segment_names(segments: DataFrame) -> DataFrame:
    """The segments there are."""
    return segments.select(SEGMENT).distinct()


def weekly_trend(features: DataFrame, skip_first: bool = False) -> DataFrame:
    """Mean 7-row change per asset.

    Rows with fewer than seven predecessors count as 0.0, or are left out with ``skip_first``.
    """
    change = F.col(CHANGE_7)
    if skip_first:
        change = F.when(F.col("prev_price_7d").isNotNull(), change)
    return features.groupBy(ASSET).agg(F.avg(change).alias("avg_weekly_change_percent"))


def segment_cap_stability(features: DataFrame) -> DataFrame:
    """How far a segment's daily mean cap strays from its mean over all days, in percent.

    The extremes follow from the largest and the smallest day, so no join back is needed.
    """
    mean, top, low = (F.col(c) for c in ("mean_cap", "_top", "_low"))
    rise = percent_change(top, mean)
    fall = percent_change(low, mean)
    return (
        segment_aggregates(features, "day")
        .groupBy(SEGMENT)
        .agg(
            F.avg("avg_market_cap").alias("mean_cap"),
            F.max("avg_market_cap").alias("_top"),
            F.min("avg_market_cap").alias("_low"),
        )
        .select(
            SEGMENT,
            "mean_cap",
            rise.alias("max_rise_percent"),
            fall.alias("max_fall_percent"),
            F.greatest(F.abs(rise), F.abs(fall)).alias("max_spread_percent"),
        )
    )
