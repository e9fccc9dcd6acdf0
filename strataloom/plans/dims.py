"""Dimensions, facts and the layers built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import dates
from strataloom.operators.windows import first_per_key, global_row_number


def build_dim(source: DataFrame, keys: Sequence[str], attrs: Sequence[str] = (), key_name: str = "dim_key", keep: str | None = None) -> DataFrame:
    """Distinct members with a surrogate key 1..n in business-key order.

    A business key with conflicting attributes raises unless `keep="first"`,
    which takes the smallest attributes.
    """
    columns = [*keys, *attrs]
    members = source.select(*columns).distinct()
    if attrs:
        if keep == "first":
            members = first_per_key(members, keys, list(attrs))
        elif (clash := members.groupBy(*keys).count().where("count > 1").limit(1).collect()):
            raise ValueError(f"business key with more than one set of attributes: {clash[0].asDict()}")
    return global_row_number(members, list(keys), key_name).select(key_name, *columns)


def calendar_dim(days: DataFrame, day: str = "day") -> DataFrame:
    """Calendar attributes for a table of dates."""
    d = F.col(day)
    return days.select(
        dates.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        dates.month_name(d).alias("month_name"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.weekofyear(d).cast("bigint").alias("iso_week"),
        dates.iso_weekday(d).cast("bigint").alias("iso_weekday"),
        dates.day_name(d).alias("day_name"),
        (dates.iso_weekday(d) >= 6).alias("is_weekend"),
    )


def date_span(source: DataFrame, col: str, day: str = "day") -> DataFrame:
    """Every date from the first to the last of a column."""
    c = F.col(col).cast("date")
    return source.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).select(F.explode(dates.days("lo", "hi")).alias(day))


def date_range(spark: SparkSession, lo: str, hi: str, day: str = "day") -> DataFrame:
    """Every date of a fixed range."""
    ends = spark.range(1).select(F.lit(lo).cast("date").alias("lo"), F.lit(hi).cast("date").alias("hi"))
    return ends.select(F.explode(dates.days("lo", "hi")).alias(day))


def time_dim(spark: SparkSession, bands: Sequence[tuple[int, str]] = dates.DAY_BANDS, opens: int = 7, closes: int = 19) -> DataFrame:
    """The 24 hours of a day; `bands` names the parts of the day by their first hour."""
    h = F.col("id").cast("bigint")
    return spark.range(24).select(
        (h + 1).alias("time_key"),
        h.alias("hour"),
        F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00")).alias("starts_at"),
        dates.part_of_day(h, bands).alias("part_of_day"),
        dates.is_business_hour(h, opens, closes).alias("is_business_hour"),
    )


def load_fact(source: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], str]], measures: dict[str, Column]) -> DataFrame:
    """Replace business keys by surrogate keys; rows without a member drop out.

    Each lookup is (dimension, business key columns, surrogate key column).
    """
    fact = source
    for dim, keys, surrogate in lookups:
        fact = fact.join(dim.select(*keys, surrogate), list(keys), "inner")
    return fact.select(*[s for _, _, s in lookups], *[c.alias(n) for n, c in measures.items()])


def split_attribute(dim: DataFrame, attr: str, sub_key: str) -> tuple[DataFrame, DataFrame]:
    """Move an attribute into its own dimension: (dimension with key, sub-dimension)."""
    sub = build_dim(dim, [attr], key_name=sub_key)
    return dim.join(sub, attr, "inner").drop(attr), sub


def conform(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """Clean and rename a raw entity; rows without a key are dropped."""
    return df.select(*[c.alias(n) for n, c in columns.items()]).where(F.col(key).isNotNull())


def medallion_silver(bronze: DataFrame, valid: Column, columns: dict[str, Column]) -> DataFrame:
    """Typed, valid rows of a raw layer."""
    return bronze.where(valid).select(*[c.alias(n) for n, c in columns.items()])
