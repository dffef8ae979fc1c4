"""Structured Streaming jobs: bronze ingest, silver apply, rate loading."""
