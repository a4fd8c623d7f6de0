"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from . import canonical, mixing, near_duplicates, packing, responses, shared_spans, splitting, subjects, truncation

MODULES = [truncation, canonical, near_duplicates, splitting, shared_spans, responses, packing, mixing, subjects]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}


def sql() -> dict[str, str]:
    """The SQL twins of all modules; those that hold compiled tables are made here."""
    return {name: text for module in MODULES for name, text in (module.sql() if hasattr(module, "sql") else module.SQL).items()}
