"""Incremental batch and Structured Streaming ingestion."""
