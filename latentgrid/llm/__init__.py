"""Operators for preparing text corpora: near duplicates, personal data, archives,
tokens, contamination, quality, languages, secrets and embeddings.

Nothing else in the library imports this package. Each operator takes DataFrames and
column names; ``queries`` holds the thin queries that apply them to the given tables.
"""
