"""Operators that prepare training data: cleaning, scoring, deduplication, packing, archives."""
