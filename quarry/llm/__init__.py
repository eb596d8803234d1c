"""Operators for large-scale training-data preparation, and the queries that apply them."""
