"""Registry of named queries: a Spark callable and, where SQL can say it, DuckDB SQL with the same columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, tuple[Query, str | None]] = {}
_LOADED = False


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its oracle SQL."""

    def add(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = (f, oracle)
        return f

    return add


def _load() -> None:
    global _LOADED
    if not _LOADED:
        _LOADED = True
        from vellumry.plans import catalog  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return {k: f for k, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: sql for k, (_, sql) in _QUERIES.items() if sql}
