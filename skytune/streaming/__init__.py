"""Structured Streaming over landed plays."""
