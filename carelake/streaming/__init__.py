"""Structured Streaming forms of the file, message and log jobs."""
