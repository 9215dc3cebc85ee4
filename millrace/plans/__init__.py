"""Queries over the supplied tables: one per operator, and the jobs composed of them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("tables", "functions", "jobs", "streams", "learning")


def all_queries():
    """Queries and SQL by name, in the order of `MODULES`."""
    from millrace.plans.catalog import QUERIES, SQL

    for module in MODULES:
        import_module(f"millrace.plans.{module}")
    return dict(QUERIES), dict(SQL)
