"""Operators on DataFrames: skew-safe joins, ranks, keys, mutation, spatial and graph work."""
