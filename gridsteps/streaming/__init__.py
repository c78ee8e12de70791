"""Ordered step exchange on Structured Streaming."""
