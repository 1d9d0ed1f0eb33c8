"""Incremental consumption of staged files (K1)."""
