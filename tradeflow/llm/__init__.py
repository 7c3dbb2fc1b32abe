"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``conversations``.

Nothing else in the library imports this package.  Every operator takes DataFrames,
selects the columns it needs by name (extra columns are dropped, so clashing names do
no harm) and returns a DataFrame; ``queries`` holds the registered queries.
"""
