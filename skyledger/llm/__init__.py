"""Operators for preparing training data at scale: deduplication, mixing, search, counting, packing."""
