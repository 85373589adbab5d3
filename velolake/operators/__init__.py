"""Operators from raw rows to marts; each one takes and returns DataFrames."""
