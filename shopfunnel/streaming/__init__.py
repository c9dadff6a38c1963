"""Structured Streaming variant of the cleaning step."""
