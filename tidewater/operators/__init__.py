"""Operators on DataFrames: joins, aggregations, windows, set operations."""
