"""Structured Streaming ingest of readings (dedupe, latest level)."""
