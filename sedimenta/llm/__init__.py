"""Operators on text and matches for training-data pipelines; nothing outside imports this package."""
