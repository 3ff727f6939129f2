"""A book of queries: each with its function and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Book:
    def __init__(self, prelude: str = "") -> None:
        self.prelude, self._queries, self._sql = prelude, {}, {}

    def query(self, sql: str | None = None, prelude: str | None = None) -> Callable[[Query], Query]:
        """Register a query under its function's name. The SQL comes after the book's prelude of ``with`` parts."""

        def add(f: Query) -> Query:
            self._queries[f.__name__] = f
            if sql is not None:
                self._sql[f.__name__] = (self.prelude if prelude is None else prelude) + sql
            return f

        return add

    def queries(self) -> dict[str, Query]:
        return dict(self._queries)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self._sql)
