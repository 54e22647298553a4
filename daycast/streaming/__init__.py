"""Structured Streaming forms of the incremental pulls."""
