"""Structured Streaming jobs over the landing folders."""
