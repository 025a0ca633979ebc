"""Structured Streaming operators and the availableNow runner."""
