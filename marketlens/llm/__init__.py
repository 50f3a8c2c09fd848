"""Operators for large text corpora, each over a table of documents (see ``queries.py``)."""
