"""Operators of a training-data pipeline: deduplication, filters, tokenisation, packing and chat formatting."""
