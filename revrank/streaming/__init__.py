"""Incremental fitting as Structured Streaming jobs."""
