"""Query registry: each named query is a Spark plan plus (optionally) its DuckDB oracle SQL.

A query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import the modules that register queries, then return the registry."""
    from sentimart.plans import queries_ingest, queries_marts, queries_stream, queries_text  # noqa: F401
    return REGISTRY
