"""Structured Streaming forms of ingestion and hourly truth."""
