"""Queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from suite import algorithm_queries, decode_queries, element_queries, load_queries, match_queries, stored_queries

MODULES = (match_queries, element_queries, load_queries, decode_queries, algorithm_queries, stored_queries)


def all_queries() -> dict:
    found: dict = {}
    for module in MODULES:
        overlap = found.keys() & module.QUERIES.keys()
        if overlap:
            raise ValueError(f"query names used twice: {sorted(overlap)}")
        found.update(module.QUERIES)
    return found
