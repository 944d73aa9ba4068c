"""Relational operators of the warning index (DataFrame in, DataFrame out)."""
