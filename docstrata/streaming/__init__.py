"""Structured Streaming forms of the jobs."""
