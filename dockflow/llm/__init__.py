"""Operators for preparing training text: fingerprints, counts, quality, safety, duplicates, mixing, encoding."""
