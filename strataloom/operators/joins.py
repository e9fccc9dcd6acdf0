"""Joins. No broadcast is forced unless its size is bounded by construction;
everything else is left to Catalyst and AQE, which check sizes themselves and
split hot keys of shuffled joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strataloom.functions.text import normalized_key


def star_join(fact: DataFrame, *steps: tuple[DataFrame, str, str], how: str = "inner") -> DataFrame:
    """Join a fact to dimensions in turn; each step is (dimension, left key, right key)."""
    for dim, left, right in steps:
        fact = fact.join(dim, F.col(left) == F.col(right), how)
    return fact


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Key equality where NULL equals NULL, as in a partition of a window."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def left_join_many(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer join for a right side in which one key may have very many rows.

    AQE can split a hot key on either side of an inner join, but not on the
    right of an outer one. So the matches come from an inner join, and the rows
    without a match from an anti join with the distinct keys.
    """
    matched = left.join(right, F.col(left_key) == F.col(right_key), "inner")
    return matched.unionByName(without_match(left, right, left_key, right_key), allowMissingColumns=True)


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left anti join; the right side is reduced to its distinct keys before the shuffle."""
    keys = right.select(F.col(right_key).alias("_right_key")).distinct()
    return left.join(keys, F.col(left_key) == F.col("_right_key"), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """Child rows whose key is set but missing in the parent, which holds each key once."""
    keys = parent.select(F.col(key).alias("_parent_key"))
    return child.where(F.col(foreign_key).isNotNull()).join(keys, F.col(foreign_key) == F.col("_parent_key"), "left_anti")


def reconcile_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Status of every normalized key: matched, left_only or right_only.

    Each side is reduced to its distinct keys first, so repeated keys are
    combined before they are shuffled.
    """
    a = _distinct_keys(left, left_key)
    b = _distinct_keys(right, right_key).withColumnRenamed("key_value", "right_value")
    status = (
        F.when(F.col("right_value").isNull(), "left_only").when(F.col("key_value").isNull(), "right_only").otherwise("matched")
    )
    return a.join(b, F.col("key_value") == F.col("right_value"), "full_outer").select(
        F.coalesce("key_value", "right_value").alias("key_value"), status.alias("status")
    )


def _distinct_keys(df: DataFrame, key: str) -> DataFrame:
    text = F.col(key).cast("string")
    return df.where(text.isNotNull()).select(normalized_key(text).alias("key_value")).distinct()


def pruned_by(fact: DataFrame, wanted: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of `fact` whose keys (fact column: wanted column) occur in `wanted`.

    On folder columns of a partitioned table Spark evaluates `wanted` first and
    reads only the folders it names (dynamic partition pruning; by the side that
    is broadcast, or, in sessions of `build_session`, by a query of its own). On
    other columns of a large shuffled fact it filters rows by a bloom filter
    before the shuffle (`spark.sql.optimizer.runtime.bloomFilter`). `wanted` must
    be filtered, or Spark sees no gain in either. Keys that `wanted` holds more
    than once are shuffled as often but give no further rows.
    """
    few = wanted.select(*[F.col(w).alias(f"_wanted_{f}") for f, w in keys.items()])
    same = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"_wanted_{f}") for f in keys])
    return fact.join(few, same, "left_semi")


def match_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Number of rows an inner join would give, without building its rows.

    Both sides are counted per key before the join, so a key with many rows on
    both sides costs one multiplication.
    """
    a = left.groupBy(F.col(left_key).alias("left_key")).agg(F.count(F.lit(1)).alias("left_n"))
    b = right.groupBy(F.col(right_key).alias("right_key")).agg(F.count(F.lit(1)).alias("right_n"))
    pairs = F.sum(F.col("left_n") * F.col("right_n"))
    return a.join(b, F.col("left_key") == F.col("right_key")).agg(F.coalesce(pairs, F.lit(0)).alias("match_count"))


def first_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str, pick: str, alias: str) -> DataFrame:
    """Value that a correlated `LIMIT 1` subquery would give, fixed to the smallest."""
    smallest = right.groupBy(F.col(right_key).alias("_match_key")).agg(F.min(pick).alias(alias))
    return left.join(smallest, F.col(left_key) == F.col("_match_key"), "left").drop("_match_key")


def with_inline_rows(df: DataFrame, rows: Sequence[Row]) -> DataFrame:
    """Every row of `df` beside every literal row.

    The literals travel inside the plan as one array, so there is no join and
    no shuffle.
    """
    names = list(rows[0].asDict())
    literal = F.array(*[F.struct(*[F.lit(r[n]).alias(n) for n in names]) for r in rows])
    return df.select("*", F.inline(literal))


def lookup_row(spark, **keys: tuple[DataFrame, str]) -> DataFrame:
    """One row of keys, each the smallest of a filtered dimension; no row if any is missing."""
    row = spark.range(1).select(*[df.agg(F.min(col)).scalar().alias(name) for name, (df, col) in keys.items()])
    return row.dropna()


def asof_join(
    fact: DataFrame,
    versions: DataFrame,
    key: str | Column,
    at: str,
    version_key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
    grain: str = "year",
    span: tuple[dt.date | Column, dt.date | Column] | None = None,
) -> DataFrame:
    """Pair each fact with the version of its key that was valid on its date, both ends included.

    Validity is spread over the years (or months) it covers, cut to the span of
    the fact, and the join runs on (key, year). A key with a third of all facts
    is thereby spread over its years, and a fact meets only the versions of its
    own year. A version that ends before the next one starts adds at most one
    row per year of its key, so the spread side stays about as large as the
    versions. It remains an equi join: broadcast if the versions are small by
    Catalyst's own estimate, shuffled otherwise.

    `span` gives the first and last date of the fact where they are known or
    cheaper to find than by another evaluation of the fact. Dates outside it
    find no version.

    Grain `key` joins on the key alone, so that the fact need not be dealt anew
    if it comes dealt by the key or is joined on it next. The versions of a key
    are gathered in one row, which suits versions of a calendar (one a month),
    whose number is bounded; a hot key of the fact is left to AQE to split.
    `span` is not needed there.
    """
    if grain == "key":
        return _asof_gathered(fact, versions, key, at, version_key, valid_from, valid_to, how)
    if grain not in ("year", "month"):
        raise ValueError(f"unknown grain {grain!r}")
    unit = "YEAR" if grain == "year" else "MM"
    if span is None:
        found = fact.agg(F.struct(F.min(at).alias("lo"), F.max(at).alias("hi"))).scalar()
        span = found["lo"], found["hi"]
    first, last = (d if isinstance(d, Column) else F.lit(d) for d in span)
    lo = F.greatest(F.col(valid_from), F.trunc(first, unit))
    hi = F.least(F.col(valid_to), last)
    periods = F.sequence(F.trunc(lo, unit), F.trunc(hi, unit), F.expr(f"interval 1 {grain}"))
    spread = versions.where(lo <= hi).withColumn("_period", F.explode(periods))
    on = (
        ((F.col(key) if isinstance(key, str) else key) == F.col(version_key))
        & (F.trunc(F.col(at), unit) == F.col("_period"))
        & F.col(at).between(F.col(valid_from), F.col(valid_to))
    )
    return fact.join(spread, on, how).drop("_period")


def _asof_gathered(fact: DataFrame, versions: DataFrame, key: str | Column, at: str, version_key: str, valid_from: str, valid_to: str, how: str) -> DataFrame:
    """`asof_join` on the key alone, with the versions of a key in one row."""
    if how not in ("inner", "left"):
        raise ValueError(f"grain 'key' knows inner and left, not {how!r}")
    rest = [c for c in versions.columns if c != version_key]
    gathered = versions.where(F.col(version_key).isNotNull()).groupBy(version_key).agg(F.collect_list(F.struct(*rest)).alias("_versions"))
    joined = fact.join(gathered, (F.col(key) if isinstance(key, str) else key) == F.col(version_key), how)
    valid = F.filter("_versions", lambda v: F.col(at).between(v[valid_from], v[valid_to]))
    # at most one version is valid unless intervals overlap, so the rows of a fact are not multiplied
    paired = joined.withColumn("_versions", valid).select(*fact.columns, version_key, (F.inline if how == "inner" else F.inline_outer)("_versions"))
    met = F.when(F.col(valid_from).isNotNull(), F.col(version_key)) if how == "left" else F.col(version_key)
    return paired.withColumn(version_key, met).select(*fact.columns, *versions.columns)
