"""Operators of a training-data pipeline: cleaning, duplicates, leaks, models, packing and archives."""
