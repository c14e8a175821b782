"""Structured Streaming forms of the periodic operators."""
