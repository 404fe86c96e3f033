"""Operators for building training corpora: sharding, extraction, tokenising, archives, safety and duplicates.

Every operator takes DataFrames and returns DataFrames; `queries.py` binds each to the
tables of a data directory.  Nothing else in the library imports this subpackage.
"""
