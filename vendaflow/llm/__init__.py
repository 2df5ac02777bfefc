"""Operators for preparing training text: token counts, secrets, packing, near-duplicates, toxicity,
repeated passages, benchmark leaks, personal data and shards. Nothing else in the library imports it."""
