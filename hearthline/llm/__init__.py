"""Operators for training data: scoring, matching, deduplication, mixing and archives.

Nothing else in the library imports this package. Each module holds one operator with its own
general interface; ``queries`` applies them to the given tables.
"""
