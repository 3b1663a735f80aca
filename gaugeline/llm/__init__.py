"""Operators of a training-data pipeline over large text corpora.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``registry`` names their queries over the given tables.
"""
