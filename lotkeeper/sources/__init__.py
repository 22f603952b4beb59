"""Readers and writers for listing snapshots, API payloads, reference data and table state."""
