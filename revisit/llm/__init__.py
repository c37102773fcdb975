"""Operators for preparing training text, each on plain DataFrames."""
