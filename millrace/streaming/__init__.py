"""Structured Streaming queries and what they report."""
