"""Operators of a training-data pipeline: tokens, duplicates, packing, filters and vectors."""
