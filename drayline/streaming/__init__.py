"""Structured Streaming forms of ingestion, state and windowed counts."""
