"""Operators of a training-data pipeline: deduplication, packing, filtering, search, classification.

Nothing else in the library imports this subpackage. ``queries`` holds the registered queries, ``oracles`` their SQL.
"""
