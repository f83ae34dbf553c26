"""Incremental ingestion of newly landed raw files (Structured Streaming)."""
