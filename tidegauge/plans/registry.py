"""Registered queries: each is a function (spark, sf_dir) and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def put(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return put


def _load() -> None:
    from importlib import import_module

    from tidegauge import plans

    for module in plans.MODULES:
        import_module(f"tidegauge.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.plans.screens import tail_screen_events

    return tail_screen_events(spark, sf_dir)
