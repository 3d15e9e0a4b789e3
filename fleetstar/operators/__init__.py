"""User-level operators: each takes star DataFrames and returns a lazy DataFrame."""
