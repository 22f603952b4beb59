"""Listing analytics on Spark: ingest, merge, clean, enrich and track classified listings."""
