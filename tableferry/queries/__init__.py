"""Runnable queries: every operator over the test tables, with the equivalent SQL."""

from tableferry.queries import auditing, loading, reconciling, shaping

_PARTS = [shaping, reconciling, auditing, loading]
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
SQL = {name: text for part in _PARTS for name, text in part.SQL.items()}
