"""Operators of a training-data pipeline: counting, scoring, filtering, deduplication, packing."""
