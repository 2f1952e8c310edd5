"""Operators for training data: deduplication, tokens, packing, scans and fingerprints."""
