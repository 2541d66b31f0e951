"""Registry of named queries, each with its SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

_MODULES = (
    "tables", "cleaning", "marts", "quality", "evaluation", "reports", "clusters", "scenarios", "serving", "streams",
)


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in _MODULES:
        import_module(f"seatplan.plans.queries.{module}")
    return dict(_QUERIES), dict(_ORACLES)
