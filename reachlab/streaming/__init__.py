"""Structured Streaming forms of the session and effective-date operators."""
