"""Structured Streaming forms of the window counts."""
