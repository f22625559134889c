"""Retail analytics on PySpark: feed ingestion, deduplication, customer history,
late-arrival tracking, quality and monitoring reports, and sales marts.

Every operator is a function over DataFrames; whatever depends on the current
time takes an explicit ``as_of``.
"""
