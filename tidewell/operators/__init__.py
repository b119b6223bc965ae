"""Data-work operators: each takes and returns DataFrames."""
