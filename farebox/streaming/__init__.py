"""Structured Streaming ingest of Bronze files into landing."""
