"""Reusable operators over any keyed table: quality, windows, top-k, joins, sampling."""
