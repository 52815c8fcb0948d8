"""Marts and reports: pure functions of DataFrames and parameters."""
