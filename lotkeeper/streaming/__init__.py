"""Incremental ingest and availability tracking with Structured Streaming."""
