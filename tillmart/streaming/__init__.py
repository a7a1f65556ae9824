"""Structured Streaming jobs. State lives in checkpoints and written tables."""
