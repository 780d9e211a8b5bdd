"""Operators on rows, records and feeds, each a function from DataFrames to a DataFrame."""
