"""Aggregations that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions.numbers import percent


def share_of_total(groups: DataFrame, measure: str, alias: str = "share_pct", places: int = 1) -> DataFrame:
    """Percent of the grand total per group; the total is a scalar subquery."""
    whole = groups.agg(F.sum(measure)).scalar()
    return groups.withColumn(alias, percent(measure, whole, places))


def scalars(spark: SparkSession, **values: DataFrame) -> DataFrame:
    """Several one-value tables side by side in one row."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in values.items()])


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, alias: str, sep: str = ", ") -> DataFrame:
    """Ordered text of the distinct values of each key.

    Repeats are removed before anything is gathered, so a group holds at most
    as many entries as there are different values.
    """
    pairs = df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), sep).alias(alias))


def first_and_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, first: str, last: str) -> DataFrame:
    """Value of the first and last row per key, with partial results per task."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(F.min_by(value, at).alias(first), F.max_by(value, at).alias(last))


def describe_columns(df: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    """count, mean, stddev, min and max, one row per column, from one pass."""
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        stats.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(x).alias("n"),
                F.round(F.avg(x), places).alias("mean"),
                F.round(F.stddev(x), places).alias("stddev"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    return df.agg(F.array(*stats).alias("_stats")).select(F.inline("_stats"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(counts)


def union_all(parts: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Concatenate by column name."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=allow_missing)
    return result


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows overall; `order` must end with a tie break."""
    return df.orderBy(*order).limit(k)


def top_k_ranked(df: DataFrame, order: Sequence[Column], k: int, alias: str = "rank") -> DataFrame:
    """Top k with its number. Only the k kept rows meet in the window."""
    from pyspark.sql import Window

    return top_k(df, order, k).withColumn(alias, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def key_sets(left: DataFrame, right: DataFrame) -> dict[str, DataFrame]:
    """Intersection and both differences of two key sets."""
    left, right = left.distinct(), right.distinct()
    return {"both": left.intersect(right), "left_only": left.subtract(right), "right_only": right.subtract(left)}


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two results holds, repeats counted; empty when they agree."""
    one = a.exceptAll(b).withColumn("only_in", F.lit("first"))
    two = b.exceptAll(a).withColumn("only_in", F.lit("second"))
    return one.unionByName(two)
