"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Each operator takes DataFrames and returns
DataFrames; ``queries`` binds them to the test tables.
"""
