"""Inputs, queries and DuckDB oracles for checking the library on the given tables."""
