"""Structured Streaming jobs over landed files."""
