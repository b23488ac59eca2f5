"""Operators of a training-data pipeline: tokens, filters, near duplicates, packing and search."""
