"""Scalar functions as Column expressions (no Python on the row path)."""
