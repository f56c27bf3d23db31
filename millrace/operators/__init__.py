"""Operators: DataFrames in, DataFrames out, columns by name."""
