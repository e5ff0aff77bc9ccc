"""A collection of queries with their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.functions.scalars import clean
from tetraframe.operators.tables import shared_folder


class Book:
    """Queries by name; an oracle is SQL with the named views in front."""

    def __init__(self, **views: str):
        self.views, self.queries, self.oracles = views, {}, {}

    def add(self, name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None, *views: str) -> None:
        """Register a query; sql may use the views named."""
        self.queries[name] = query
        if sql is not None:
            sql, front = sql.strip(), ", ".join(self.views[v] for v in views)
            if front:
                sql = f"WITH {front}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {front}\n{sql}"
            self.oracles[name] = sql


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that two engines agree."""
    return df.select(*(clean(F.col(f.name), digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema))


def r(*columns: str, digits: int = 6) -> str:
    """The same in SQL: "expr AS name" or "name"."""
    out = []
    for c in columns:
        e, _, n = c.rpartition(" AS ")
        out.append(f"round({e or n} + 1.7e-9, {digits}) + 0.0 AS {n}")
    return ", ".join(out)


def folder(spark: SparkSession, name: str) -> str:
    """The address of a new folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
