"""Structured Streaming file ingest."""
