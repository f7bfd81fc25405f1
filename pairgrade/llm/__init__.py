"""Operators for building training corpora.

One module per operator; ``registry`` holds their queries and SQL.  Nothing
else in the library imports this package.
"""
