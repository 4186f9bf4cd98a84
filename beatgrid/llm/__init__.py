"""Operators for preparing training data: filters, fingerprints, deduplication, mixing, scoring, tokens."""
