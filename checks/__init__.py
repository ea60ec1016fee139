"""Queries over the given tables and their DuckDB counterparts."""
