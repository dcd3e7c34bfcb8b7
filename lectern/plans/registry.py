"""Registered queries: one per operator key of the survey inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver's tables and has,
where SQL can express it, a DuckDB oracle string returning the same columns.
Array results are emitted as space-joined strings so values hash unambiguously;
doubles are rounded to 6 places in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from . import q_catalog, q_corpus, q_model  # noqa: F401
