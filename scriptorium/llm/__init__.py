"""Operators that prepare training data: deduplication, filtering, mixing, formatting, packing and scoring."""
