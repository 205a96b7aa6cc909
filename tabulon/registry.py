"""Query registry: a name, a function over the input tables, and its check in SQL."""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

_RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The input tables of one directory, read lazily: ``t.orders`` is a parquet scan."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def sql(self, text: str, **args) -> DataFrame:
        """Spark SQL over the tables named in braces, with ``:name`` parameters."""
        frames = {f: getattr(self, f) for _, f, _, _ in Formatter().parse(text) if f}
        return self.spark.sql(text, args=args, **frames)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; ``sql`` is the statement that must give the same rows."""

    def register(fn):
        if name in _RUN:
            raise ValueError(f"query {name} is registered twice")
        _RUN[name] = lambda spark, path: fn(Tables(spark, path))
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def registered():
    return dict(_RUN), dict(_SQL)
