"""Structured Streaming: landing, live tables, monitoring."""
