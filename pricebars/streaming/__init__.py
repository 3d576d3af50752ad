"""Structured Streaming jobs over a file source."""
