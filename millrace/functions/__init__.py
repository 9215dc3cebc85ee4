"""Scalar functions as Column expressions, and the same functions under a name in SQL."""
