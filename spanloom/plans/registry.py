"""Registry of queries: each operator registers a Spark query and, where there is one, the DuckDB SQL for the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def operator(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return register


def load() -> None:
    """Import all modules that register operators."""
    from . import catalog

    for module in catalog.MODULES:
        importlib.import_module(f"spanloom.{module}")
