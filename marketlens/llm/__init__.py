"""Operators of a large training-data pipeline over whole text tables (see the README)."""
