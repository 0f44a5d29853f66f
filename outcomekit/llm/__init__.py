"""Operators that prepare training text: sharding, mixing, filters, near and exact duplicates."""
