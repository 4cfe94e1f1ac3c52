"""Readers: landing-zone formats, raw-table scans, sinks, and stand-in raw tables over the driver tables."""
