"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` binds them to the
registered queries and ``oracle.py`` holds the SQL of those that SQL can
express.
"""
