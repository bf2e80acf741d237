"""Operators for building training data from text, each a plain function on DataFrames."""
