"""Readers: catalog tables, files, databases."""

from .files import checked_lines, is_committed, read_if_committed, read_lines
from .tables import read_jdbc, read_table, select_from

__all__ = [
    "checked_lines",
    "is_committed",
    "read_if_committed",
    "read_jdbc",
    "read_lines",
    "read_table",
    "select_from",
]
