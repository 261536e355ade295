"""Registered queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its own tests check it."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from quire.plans import (  # noqa: F401
        answer_queries,
        chat_queries,
        load_queries,
        page_queries,
        report_queries,
        search_queries,
        stream_queries,
        table_queries,
    )
