"""Registry of named queries: a Spark builder and, where SQL can express it,
the equivalent DuckDB SQL used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def load_all() -> None:
    """Import every plan module so its queries register themselves."""
    from tessera.plans import (  # noqa: F401
        requests, runlog, pacing, vectors, governance, retrieval, evals, cohort, streams, failures,
        responses)
