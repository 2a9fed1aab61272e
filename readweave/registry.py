"""Collects the queries and their SQL twins that the operator modules register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Named queries; ``sql`` is the DuckDB text that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = sql
