"""Structured Streaming versions of ingest."""
