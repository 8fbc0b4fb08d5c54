"""Whole jobs: the daily run, the personal-finance preset, and queries over sample tables."""
