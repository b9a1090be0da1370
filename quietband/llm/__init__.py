"""Operators of a training-data pipeline: sharding, archives, packing, scans, deduplication, tokens, scoring."""
