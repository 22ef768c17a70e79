"""Incremental counterparts of batch operators for Structured Streaming."""
