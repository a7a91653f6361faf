"""Operators for preparing language-model training data.

Ten operators over ``documents`` and ``conversations`` and the registry of
their queries (``queries.py``). Nothing outside this package imports it.
"""
