"""Structured Streaming: ingest, quality gate, incremental warehouse, daily windows."""
