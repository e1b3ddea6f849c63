"""Writes: slices and tables of the warehouse, and relational tables."""
