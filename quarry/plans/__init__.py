"""Registered queries over the given tables, each with its DuckDB-checkable SQL where one exists."""

from quarry.plans.registry import ORACLE, QUERIES, load_all  # noqa: F401
