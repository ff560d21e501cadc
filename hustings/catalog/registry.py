"""Registration of queries and a loader for the standard tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of one folder by name: ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, *names: str, **frames: DataFrame) -> DataFrame:
        """A derived table in SQL that both engines understand; ``{orders}`` names a table."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in names}, **frames)


def query(name: str, sql: str | None = None):
    """Registers ``fn(tables)`` under a name, with the SQL that gives the same rows."""
    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            return fn
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn
    return add
