"""Batch operators: every function takes and returns a DataFrame."""
