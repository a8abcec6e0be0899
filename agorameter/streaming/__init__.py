"""Structured Streaming: starting sinks, idempotent batch writes, trends with late data."""
