"""Collects the queries and their SQL as the catalogue modules define them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(job: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = job
        if sql is not None:
            SQL[name] = sql
        return job

    return add
