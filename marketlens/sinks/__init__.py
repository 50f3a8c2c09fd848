"""Writers: Parquet, CSV, catalog, and small results to the driver."""

from .checked import read_accepted, read_rejected, stream_checked, write_checked
from .csv import append_lines, write_combined, write_daily
from .local import first_rows, scalar_text, show_first, to_local
from .parquet import register_table, write_partitioned, write_plain

__all__ = [
    "append_lines",
    "first_rows",
    "read_accepted",
    "read_rejected",
    "register_table",
    "scalar_text",
    "show_first",
    "stream_checked",
    "to_local",
    "write_checked",
    "write_combined",
    "write_daily",
    "write_partitioned",
    "write_plain",
]
