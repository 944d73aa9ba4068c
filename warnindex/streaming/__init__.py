"""Incremental (Structured Streaming) ingestion of landed message files."""
