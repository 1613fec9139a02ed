"""Incremental ingest of arriving schedule files (Structured Streaming)."""
