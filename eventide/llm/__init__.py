"""Operators of a training-data pipeline over document, page and chat tables.

Each module holds one operator with a general interface; ``queries.py`` applies
them to the driver tables.  Nothing outside this package imports it.
"""
