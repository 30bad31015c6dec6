"""Incremental ingest of landed raw files."""
