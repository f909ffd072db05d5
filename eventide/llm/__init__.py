"""Operators of a training-data pipeline: cleaning, deduplicating, scoring and packing documents."""
