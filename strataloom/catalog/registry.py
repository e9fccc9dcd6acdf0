"""Register of queries: a function of the tables, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataloom.session import configure
from strataloom.sources.files import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables)` under a name; without SQL only the rows are checked."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark), folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


# Pieces of SQL that mirror strataloom.functions.numbers.
def sql_money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def sql_total(x: str) -> str:
    return f"CAST(SUM({sql_money(x)}) AS DOUBLE)"


def sql_mean(x: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST(AVG({sql_money(x)}) AS DECIMAL(28,6)), {places}) AS DOUBLE)"


def sql_round(x: str, places: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), {places}) AS DOUBLE)"


SQL_NET = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))"
SQL_REVENUE = f"CAST(SUM({SQL_NET}) AS DOUBLE)"
