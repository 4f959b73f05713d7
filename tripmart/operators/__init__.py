"""Transformations and sinks on DataFrames."""
