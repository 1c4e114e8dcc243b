"""Inputs: bronze derived from the driver tables, bronze Parquet, JSON events."""
