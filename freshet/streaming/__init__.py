"""Structured Streaming forms of landing and ingest."""
