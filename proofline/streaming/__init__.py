"""Incremental daily ingestion with Structured Streaming."""
