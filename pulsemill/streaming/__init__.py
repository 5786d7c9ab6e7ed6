"""Structured Streaming forms of ingest, windowed means and deduplication."""
