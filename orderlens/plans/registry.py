"""Named queries: a Spark callable and, where SQL can say it, the equivalent statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


class Registry(dict):
    """name -> Entry."""

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(fn: Query) -> Query:
            self[fn.__name__] = Entry(fn, sql)
            return fn
        return add
