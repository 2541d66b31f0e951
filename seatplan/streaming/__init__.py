"""Structured Streaming ingest and publishing."""
