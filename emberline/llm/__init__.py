"""Operators for preparing training text: language, duplicates, leaks, personal data, mixes, token counts."""
