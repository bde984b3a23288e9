"""Operators from DataFrames to a DataFrame; none of them collects or writes."""
