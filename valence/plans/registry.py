"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

from valence.plans import feed_queries, knn_queries, linear_queries, nb_queries, text_queries

_MODULES = (text_queries, nb_queries, knn_queries, feed_queries, linear_queries)


def queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
