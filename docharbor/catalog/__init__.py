"""Queries over the given tables, one per operator, each with a check in SQL."""

from docharbor.catalog import loading, merging, nesting, outcomes, reading, system_tables, values
from docharbor.catalog.registry import QUERIES, Tables, run

__all__ = [
    "QUERIES",
    "Tables",
    "loading",
    "merging",
    "nesting",
    "outcomes",
    "reading",
    "run",
    "system_tables",
    "values",
]
