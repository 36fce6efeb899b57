"""Structured Streaming forms of the ingest, the rollups and the document log."""
