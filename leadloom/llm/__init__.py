"""Operators of a training-data pipeline: scans, archives, extraction, filters, dedup, mixing, token files."""
