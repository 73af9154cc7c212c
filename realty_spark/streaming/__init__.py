"""Incremental ingestion of registry extracts (Structured Streaming)."""
