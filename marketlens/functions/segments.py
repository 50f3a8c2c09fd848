"""Segment label of an asset."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import STABLE, STABLE_SYMBOLS, VOLATILE


def segment_of(
    symbol: Column, stable_symbols: Iterable[str] = STABLE_SYMBOLS, normalize: bool = False
) -> Column:
    """``stablecoin`` for listed symbols, else ``volatile``.

    The test is case-sensitive, as the batch job's users know it; ``normalize`` upper-cases first.
    """
    tested = F.upper(symbol) if normalize else symbol
    return F.when(tested.isin(*stable_symbols), F.lit(STABLE)).otherwise(F.lit(VOLATILE))
