"""Structured Streaming forms of the scoring route."""
