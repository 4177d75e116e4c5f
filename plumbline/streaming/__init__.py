"""Structured Streaming variants of the quality metrics."""
