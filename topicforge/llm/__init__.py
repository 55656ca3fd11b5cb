"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when the folder is there.  One module per operator, each with its
general interface; ``queries`` holds the thin registered queries and their SQL.
"""
