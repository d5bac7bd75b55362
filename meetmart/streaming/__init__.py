"""Structured Streaming ingest of landed webhooks."""
