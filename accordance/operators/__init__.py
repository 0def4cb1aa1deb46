"""Lazy functions from DataFrames to DataFrames."""
