"""Streaming: request-pair scoring as a Structured Streaming query."""
