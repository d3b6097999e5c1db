"""Structured Streaming: change streams, enrichment, keyed upserts, late data."""
