"""Incremental capture ingest with Structured Streaming."""
