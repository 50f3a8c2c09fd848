"""CSV lines to columns and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CORRUPT, SNAPSHOT_SCHEMA


def line_to_struct(line: Column, schema: T.StructType = SNAPSHOT_SCHEMA) -> Column:
    """Parse one CSV line; a line that does not fit is kept whole in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_csv(
        line.cast("string"),
        with_corrupt.toDDL(),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def columns_to_line(*columns: Column | str) -> Column:
    """One headerless CSV line from columns."""
    return F.to_csv(F.struct(*columns))
