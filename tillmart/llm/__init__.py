"""Operators that prepare training data: mixing, tokens, filters, near duplicates."""
