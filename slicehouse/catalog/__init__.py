"""The queries by name, on the generated tables, each with the SQL text that gives the same rows in another engine."""

from __future__ import annotations

from slicehouse.catalog import columns, database, graphs, reports, status, warehouse

MODULES = (reports, columns, warehouse, database, status, graphs)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
