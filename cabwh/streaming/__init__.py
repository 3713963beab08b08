"""Incremental intake of file drops with Structured Streaming."""
