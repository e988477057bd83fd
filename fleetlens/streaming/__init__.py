"""Structured Streaming jobs over files."""
