"""Structured Streaming jobs that score a keyed message log."""
