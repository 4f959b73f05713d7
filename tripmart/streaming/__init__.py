"""Incremental runs on the Structured Streaming file source."""
