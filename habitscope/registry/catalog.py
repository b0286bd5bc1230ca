"""Registry: key -> query function, key -> SQL text."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from habitscope.sources.session import importable_by_workers, suit_wide_tables

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

MODULES = (
    "q_sources", "q_clean", "q_encode", "q_derive", "q_relational", "q_reports", "q_explore",
    "q_models", "q_invariants",
)


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``oracle`` only its rows can be checked."""
    def register(function: Query) -> Query:
        if key in _QUERIES:
            raise ValueError(f"duplicate key {key}")

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(importable_by_workers(suit_wide_tables(spark)), sf_dir)

        _QUERIES[key] = run
        if oracle is not None:
            _ORACLES[key] = oracle
        return function
    return register


def _load() -> None:
    for module in MODULES:
        import_module(f"habitscope.registry.{module}")


def query_functions() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_texts() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
