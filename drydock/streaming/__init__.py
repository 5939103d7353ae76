"""Structured Streaming forms of the snapshot and completion operators."""
