"""Structured Streaming jobs over ticks and landed files."""
