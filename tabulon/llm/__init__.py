"""Operators for preparing training text: ten numbered operators and their registered queries.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
``queries.QUERIES`` when it is present.  Every module docstring states the
result of its operator on nulls, empty and very long texts, ties, repeated rows
and empty tables.
"""
