"""Operators: each takes a DataFrame and returns one."""
