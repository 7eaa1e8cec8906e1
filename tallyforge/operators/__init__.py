"""Operators: lazy functions from DataFrames to DataFrames."""
