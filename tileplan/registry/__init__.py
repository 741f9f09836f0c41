"""Every operator as a named query over the derived tables, with DuckDB SQL where the result can be stated in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tileplan.fixtures import FixtureCatalogue, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(fx)``, a function of the derived catalogue, under ``name`` with its SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: fn(FixtureCatalogue(spark, root))
        if sql:
            ORACLE[name] = with_tables(sql)
        return fn

    return add


def load() -> None:
    from tileplan.registry import (  # noqa: F401
        filters, functions, inputs, manifests, names, sources, status, streams, tasks, triggers,
    )
