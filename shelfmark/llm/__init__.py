"""Operators that prepare training data: cleaning, deduplication, mixing, ordering and output."""
