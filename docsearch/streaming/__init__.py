"""Applying a change feed with Structured Streaming."""
