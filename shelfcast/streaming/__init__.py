"""Structured Streaming entry points (the original is batch only; streaming is
used here only to score horizon files as they arrive)."""
