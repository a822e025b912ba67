"""Operators on DataFrames of change rows: checks, ordering, apply and progress."""
