"""Structured Streaming jobs over payment lines."""
