"""Incremental feeds built on Structured Streaming."""
