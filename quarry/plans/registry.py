"""Registry of named queries: a Spark builder and, where SQL can say it, a
DuckDB oracle over the same driver tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, (fn.__doc__ or "").strip().split("\n")[0])
        return fn

    return deco


def with_views(body: str, **views: str) -> str:
    """``WITH v1 AS (...), v2 AS (...) body`` (views in the given order)."""
    if not views:
        return body
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in views.items())
    return f"WITH {ctes}\n{body}"
