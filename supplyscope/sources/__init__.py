"""Readers, writers, captured-page extraction and test-table adapters."""
