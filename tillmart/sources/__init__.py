"""Readers and writers. Formats and locations are parameters."""
