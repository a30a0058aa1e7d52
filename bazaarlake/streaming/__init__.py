"""Structured Streaming forms of the live reports."""
