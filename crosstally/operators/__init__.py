"""Reconciliation operators: DataFrames in, DataFrames out, no provider names."""
