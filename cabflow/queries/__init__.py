"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

from importlib import import_module

from cabflow.queries.base import QUERIES, Query

MODULES = ("columns", "rows", "groups", "files", "jobs")


def load() -> dict[str, Query]:
    """All queries by name."""
    for module in MODULES:
        import_module(f"cabflow.queries.{module}")
    return QUERIES
