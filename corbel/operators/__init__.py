"""Whole-frame operators: each takes and returns lazy DataFrames."""
