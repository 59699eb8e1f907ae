"""Scans, sinks, ingestion stamps and the adapters over the given tables."""
