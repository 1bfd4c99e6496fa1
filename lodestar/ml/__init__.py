"""Spark ML wrappers: formula encoding, fits, scoring, evaluation, search."""
