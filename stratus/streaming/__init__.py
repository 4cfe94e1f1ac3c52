"""Structured Streaming jobs: the hourly feed over a landing zone."""
