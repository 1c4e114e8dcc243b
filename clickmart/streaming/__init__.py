"""Structured Streaming: ingest sink, live metrics, stream dedup, progress log."""
