"""Operators over observation tables. Each takes and returns DataFrames."""
