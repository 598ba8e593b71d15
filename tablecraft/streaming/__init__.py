"""Structured Streaming forms: incremental ingest of file drops."""
