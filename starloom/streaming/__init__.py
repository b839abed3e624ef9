"""Incremental ingest of landed JSON event files (Structured Streaming)."""
