"""Operators for building training corpora, and the queries that run them.

Nothing else in the library imports this package; it imports general helpers (session,
scratch folders) from the rest.  One module per operator, ``catalogue`` has the queries.
"""
