"""Operators for training-data pipelines: fingerprints, tokenising, near-duplicates, extraction, models, audits, privacy."""
