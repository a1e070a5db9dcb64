"""Operators for training-data pipelines: filtering, deduplication, search, tokens and packing."""
