"""Queries over the driver tables, each with the SQL that states its expected result."""

from __future__ import annotations

from tidemill.catalog import eda, formats, loading, pipelines, quality, relational, star, texts

MODULES = (star, relational, quality, eda, texts, formats, loading, pipelines)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
