"""Catalogue of named reports: ``name -> builder(spark, sf_dir)`` and its SQL oracle.

Each report is registered with the ANSI SQL (DuckDB dialect) that computes
the same result from the same tables; the SQL is written independently in
the straightforward per-row style of the original queries, while the Spark
builder uses the scalable plan.  Reports without a SQL form register none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}
OPS: dict[str, tuple[str, ...]] = {}


def report(name: str, ops: tuple[str, ...] = (), sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate report {name}")
        QUERIES[name] = fn
        OPS[name] = tuple(ops)
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco
