"""Registry of queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.session import deal_by_input, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The driver's tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.paths = tune(spark), folder, set()

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        table = self.spark.read.parquet(path)
        if path not in self.paths:
            self.paths.add(path)
            deal_by_input(self.spark, self.paths)
        return table


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return build

    return register
