"""Structured Streaming ingestion and windowed aggregation."""
