"""Structured Streaming forms of the hourly and weighted roll-ups (extra, SURVEY 2.11)."""
