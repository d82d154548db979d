"""Operators for training-data pipelines (the numbered list in the README)."""
