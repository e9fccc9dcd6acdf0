"""Slowly changing dimensions: build from snapshots, merge, close and query."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions.dates import open_end
from strataloom.operators.windows import first_per_key


def scd2_from_snapshots(snapshots: DataFrame, key: str, at: str, attrs: Sequence[str], version_key: str = "version_key") -> DataFrame:
    """One version per snapshot, valid until the day before the next one.

    Snapshots hold a key once per period, so the window of a key is as long as
    the number of periods and no longer. Unchanged snapshots still give a new
    version, and a missing period stretches the version before it.
    """
    upcoming = F.lead(at).over(Window.partitionBy(key).orderBy(at))
    return snapshots.withColumn("_next", upcoming).select(
        F.concat(F.col(key).cast("string"), F.lit(":"), F.date_format(at, "yyyy-MM-dd")).alias(version_key),
        key,
        *attrs,
        F.col(at).alias("valid_from"),
        F.coalesce(F.date_sub("_next", 1), open_end()).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def scd2_add_snapshots(dim: DataFrame, snapshots: DataFrame, key: str, at: str, attrs: Sequence[str], version_key: str = "version_key") -> DataFrame:
    """Merge snapshots of any dates, late ones included, into versions of `scd2_from_snapshots`.

    A late snapshot splits the interval it falls into: the version there ends
    the day before, and the new one lasts to the next version of its key. One
    dated before the first version is put in front, one dated at the start of a
    version replaces its attributes (of several for one date, the greatest), so
    a repeated merge changes nothing. Snapshots may come in any order and
    grouping; the result is what all of them give at once. Keys of `dim` that
    the snapshots do not name are passed on unchanged, and only the versions of
    named keys are ordered anew.
    """
    named = snapshots.select(F.col(key).alias("_named")).distinct()
    same = dim[key].eqNullSafe(named["_named"])
    touched = dim.join(named, same, "left_semi").select(key, F.col("valid_from").alias(at), *attrs, F.lit(0).alias("_late"))
    points = touched.unionByName(snapshots.select(key, at, *attrs, F.lit(1).alias("_late")))
    one = points.groupBy(key, at).agg(F.max(F.struct("_late", *attrs)).alias("_it")).select(key, at, *[F.col("_it")[a].alias(a) for a in attrs])
    rebuilt = scd2_from_snapshots(one, key, at, attrs, version_key)
    return dim.join(named, same, "left_anti").unionByName(rebuilt.select(dim.columns))


def scd2_join_equal(dim: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Join neighbouring versions of a key that agree in all tracked columns and leave no day between them.

    Columns that are neither keys nor tracked take the value of the first
    version of the run. NULL equals NULL.
    """
    order = Window.partitionBy(*keys).orderBy("valid_from")
    content = F.struct(*tracked)
    begins = ~(F.lag(content).over(order).eqNullSafe(content) & (F.date_add(F.lag("valid_to").over(order), 1) >= F.col("valid_from")))
    runs = dim.withColumn("_begins", F.coalesce(begins, F.lit(True))).withColumn("_run", F.count_if("_begins").over(order))
    rest = [c for c in dim.columns if c not in {*keys, "valid_to", "is_current"}]
    joined = runs.groupBy(*keys, "_run").agg(
        F.min_by(F.struct(*rest), "valid_from").alias("_first"), F.max("valid_to").alias("valid_to"), F.bool_or("is_current").alias("is_current")
    )
    return joined.select(*[F.col("_first")[c].alias(c) if c in rest else F.col(c) for c in dim.columns])


def scd2_initial(source: DataFrame, keys: Sequence[str], attrs: Sequence[str], valid_from: str) -> DataFrame:
    """First load: every row is current from a given day."""
    return source.select(
        *keys, *attrs, F.lit(valid_from).cast("date").alias("valid_from"), open_end().alias("valid_to"), F.lit(True).alias("is_current")
    )


def scd2_merge(dim: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str | Column) -> DataFrame:
    """New version for each key whose tracked columns changed; new keys are added.

    `source` holds each key once. Keys missing from it stay as they are. Running
    the same source again changes nothing, and a second change on the day a
    version began replaces that version instead of leaving an empty range.
    Columns that are not tracked keep the value of the open version until the
    next tracked change. A change dated before the open version began fails the
    query. NULL keys are compared as values.
    """
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    attrs = [c for c in dim.columns if c not in {*keys, "valid_from", "valid_to", "is_current"}]
    closed = dim.where(F.col("valid_to") != open_end())
    current = dim.where(F.col("valid_to") == open_end()).select(
        *keys, *[F.col(a).alias(f"old_{a}") for a in attrs], F.col("valid_from").alias("old_from"), F.lit(True).alias("in_dim")
    )
    incoming = source.select(*[F.col(k).alias(f"new_key_{k}") for k in keys], *[F.col(a).alias(f"new_{a}") for a in attrs], F.lit(True).alias("in_source"))
    equal = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"new_key_{k}")) for k in keys])
    joined = current.join(incoming, equal, "full_outer").withColumns({k: F.coalesce(F.col(k), F.col(f"new_key_{k}")) for k in keys})

    in_dim, in_source = F.col("in_dim").isNotNull(), F.col("in_source").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in tracked])
    changed = in_dim & in_source & ~same
    began_today = F.col("old_from") == day
    late = F.raise_error(F.concat(F.lit("change dated before the open version of "), F.to_json(F.struct(*keys))))
    changed = F.when(changed & (F.col("old_from") > day), late.cast("boolean")).otherwise(changed)

    def version(side: str, start: Column, end: Column, is_current: bool) -> Column:
        return F.struct(
            *[F.col(f"{side}_{a}").alias(a) for a in attrs],
            start.alias("valid_from"),
            end.alias("valid_to"),
            F.lit(is_current).alias("is_current"),
        )

    kept = F.when(in_dim & ~changed, version("old", F.col("old_from"), open_end(), True)).when(
        changed & ~began_today, version("old", F.col("old_from"), F.date_sub(day, 1), False)
    )
    added = F.when((in_source & ~in_dim) | changed, version("new", day, open_end(), True))
    versions = F.filter(F.array(kept, added), lambda v: v.isNotNull())
    return joined.select(*keys, F.inline(versions)).select(dim.columns).unionByName(closed)


def scd2_replace_member(dim: DataFrame, key: str, value, changes: dict[str, Column], as_of: str) -> DataFrame:
    """Close the open version of one member and open a successor with changed attributes."""
    day = F.lit(as_of).cast("date")
    hit = (F.col(key) == F.lit(value)) & (F.col("valid_to") == open_end())
    hit = F.coalesce(hit, F.lit(False))
    old = F.struct(
        *[
            F.date_sub(day, 1).alias(c) if c == "valid_to" else F.lit(False).alias(c) if c == "is_current" else F.col(c)
            for c in dim.columns
        ]
    )
    new = F.struct(*[day.alias(c) if c == "valid_from" else changes[c].alias(c) if c in changes else F.col(c) for c in dim.columns])
    same = F.struct(*[F.col(c) for c in dim.columns])
    return dim.select(F.inline(F.when(hit, F.array(old, new)).otherwise(F.array(same))))


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("valid_to") == open_end())


def version_counts(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("version_count"))


def previous_versions(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest closed version of each key."""
    ties = [F.col(c) for c in dim.columns if c not in {*keys, "valid_from"}]
    return first_per_key(dim.where(F.col("valid_to") != open_end()), keys, [F.col("valid_from").desc(), *ties])


def overlaps(dim: DataFrame, key: str) -> DataFrame:
    """Versions that end on or after the start of the next version of their key."""
    upcoming = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from", "valid_to"))
    return dim.withColumn("next_valid_from", upcoming).where(F.col("valid_to") >= F.col("next_valid_from"))
