"""Compositions: fixtures, the checked queries, the daily pipeline."""
