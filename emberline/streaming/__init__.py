"""Continuous intake of post events and its counters."""
