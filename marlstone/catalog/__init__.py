"""Registered queries: each binds an operator to the given tables, with equivalent SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "order_queries",
    "table_queries",
    "donor_queries",
    "window_queries",
    "text_queries",
    "model_queries",
)


def all_queries() -> dict:
    """Name to query, over all domains."""
    found: dict = {}
    for module in _MODULES:
        for name, query in import_module(f"marlstone.catalog.{module}").QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = query
    return found
