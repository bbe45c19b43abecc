"""A list of queries with the SQL that checks them; nothing is built before a query is asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxmill.session import table


class Registry:
    def __init__(self) -> None:
        self._build: dict[str, Callable] = {}
        self._sql: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Callable[[str], DataFrame]], DataFrame], sql: str | None = None) -> None:
        """``build`` gets a function from a table's name to the table."""
        assert name not in self._build, name
        self._build[name] = build
        if sql is not None:
            self._sql[name] = sql

    def queries(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
            def run(spark: SparkSession, d: str) -> DataFrame:
                return self._build[name](lambda t: table(spark, d, t))

            run.__name__ = name
            return run

        return {name: query(name) for name in self._build}

    def oracle_sql(self) -> dict[str, str]:
        return dict(self._sql)
