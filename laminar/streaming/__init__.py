"""Structured Streaming jobs: deduplicating ingest and windowed daily activity."""
