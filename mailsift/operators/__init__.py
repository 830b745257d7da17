"""Operators on DataFrames of files, leaves and ledgers."""
