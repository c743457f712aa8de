"""The queries of this folder, by name, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(job):
        QUERIES[name] = job
        if sql is not None:
            SQL[name] = sql
        return job

    return add
