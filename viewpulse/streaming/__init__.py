"""Structured Streaming forms of the indicators."""
