"""Operators of a training-data pipeline: deduplication, search, extraction, filters, packing."""
