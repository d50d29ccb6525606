"""Readers that return batch or streaming DataFrames."""
