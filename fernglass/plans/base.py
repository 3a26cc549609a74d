"""What the query modules share: the decorator that registers a query, and table readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Family:
    """The queries of one module."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def register(build):
            if name in self.queries:
                raise ValueError(f"registered twice: {name}")
            self.queries[name] = build
            if sql is not None:
                self.sql[name] = sql
            return build

        return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Tables:
    """Tables of a folder by attribute: Tables(spark, folder).orders."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._folder, name)
