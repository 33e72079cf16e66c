"""Operators for preparing training text: filters, deduplication, tokens, classifiers.

Nothing outside this package imports it. Each operator module states its method, the result for nulls,
empty and very long texts, ties, repeated rows and empty tables, and takes frames with any extra columns.
"""
