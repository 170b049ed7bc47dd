"""All queries of the engine's own operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bookloom.plans import conversion, curation, documents, identity, packaging, portfolio, reports, works

_MODULES = [documents, works, portfolio, packaging, identity, conversion, curation, reports]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by its name."""
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
