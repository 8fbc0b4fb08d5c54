"""Operators of a training-data pipeline: dedup, cleaning, decontamination, mixing, output."""
