"""Fields of JSON payloads held as variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(payload: Column, path: str, as_type: str) -> Column:
    """Value at a path; null where it is missing, null or of another type."""
    return F.try_variant_get(payload, path, as_type)


def field_or(payload: Column, path: str, as_type: str, default: float) -> Column:
    """As ``field``, but the default for a missing path. An explicit null stays null."""
    missing = F.try_variant_get(payload, path, "variant").isNull()
    return F.when(missing, F.lit(default)).otherwise(field(payload, path, as_type))
