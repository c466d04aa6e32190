"""Incremental ingestion with Structured Streaming, one availableNow run at a time."""
