"""Operators from DataFrames to a DataFrame, independent of any table."""
