"""Operators for training-data pipelines: filters, near-duplicates, mixing and tokens."""
