"""Registry of runnable queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure_tables, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Attribute access to the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its SQL counterpart."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure_tables(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
