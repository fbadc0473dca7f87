"""Operators on whole DataFrames."""
