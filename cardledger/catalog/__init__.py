"""Registered queries: each runs a job or operator over the whole given tables, with its check SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("ingest", "rows", "lookups", "totals", "order", "values", "jobs", "changes", "streams")


def load() -> tuple[dict, dict]:
    queries: dict = {}
    checks: dict = {}
    for name in MODULES:
        registry = import_module(f"cardledger.catalog.{name}").REGISTRY
        queries.update(registry.queries)
        checks.update(registry.checks)
    return queries, checks
