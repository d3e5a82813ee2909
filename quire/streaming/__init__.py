"""Incremental runs with Structured Streaming (file sources, foreachBatch)."""
