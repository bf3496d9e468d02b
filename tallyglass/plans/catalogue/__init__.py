"""Registered queries and their oracles, grouped by kind of operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Views, oracle_text

_QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a query; ``oracle`` is SQL over the base tables and the views."""

    def add(fn: Callable[[Views], DataFrame]):
        key = name or fn.__name__
        if key in _QUERIES:
            raise ValueError(f"{key} is registered twice")
        _QUERIES[key] = fn
        if oracle:
            _ORACLES[key] = oracle_text(oracle)
        return fn

    return add


def _load() -> None:
    from . import aggregates, facets, people, records, scalars, scans, tables  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def run(fn):
        return lambda spark, folder: fn(Views(spark, folder))

    return {k: run(fn) for k, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
