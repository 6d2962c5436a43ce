"""Operators: pure functions from DataFrames (and parameters) to a DataFrame."""
