"""Whole runs: intake, extraction, prediction; and the registered queries with their SQL counterparts."""
