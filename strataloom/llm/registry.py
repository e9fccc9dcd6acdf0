"""Register of this package's queries, kept apart from the library's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(spark, read)` under a name; `read("documents")` is a whole table of the folder."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return fn(spark, lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register
