"""Operators for training-data pipelines: deduplication, quality, mixing, tokens."""
