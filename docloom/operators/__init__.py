"""Operators of the dataset pipeline, each a function from DataFrames to a DataFrame."""
