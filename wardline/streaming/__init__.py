"""Structured Streaming twin of the alert feed."""
