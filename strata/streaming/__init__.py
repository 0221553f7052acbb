"""Incremental file ingest with Structured Streaming (K9)."""
