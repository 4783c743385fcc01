"""Operators of a large-scale training-data pipeline, on Spark DataFrames.

Nothing else in the library imports this package. Each module holds one
operator with its own general interface; ``queries`` holds the thin
registered queries and their SQL.
"""
