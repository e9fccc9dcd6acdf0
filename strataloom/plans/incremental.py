"""Upserts, incremental loads, gap finding and change logs on plain Parquet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.functions.dates import days
from strataloom.operators.windows import first_per_key
from strataloom.sources.versioned import DayTable, replace_days


def one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows unchanged if each key occurs once; otherwise the query that reads them fails."""
    others = [c for c in rows.columns if c not in keys]
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others) if others else F.lit(True)).alias("_row"))
    message = F.concat(F.lit("several source rows for one key: "), F.to_json(F.struct(*keys)))
    sure = held.withColumn("_row", F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_row")))
    return sure.where("_row IS NOT NULL").select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], latest_by: Sequence[Column] | None = None) -> DataFrame:
    """Rows of `source` replace rows of `target` with the same key; the last write wins.

    Without `latest_by`, which picks one, a key that occurs twice in `source`
    fails the query. The target is only filtered by an anti join, so a small source is broadcast
    by Catalyst and a large target is not shuffled at all.
    """
    if latest_by is not None:
        source = first_per_key(source, keys, latest_by)
    else:
        source = one_per_key(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source rows whose key the target does not have.

    Of several source rows with one key the smallest is taken, so that a rerun
    picks the same one.
    """
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    others = [c for c in source.columns if c not in keys]
    return target.unionByName(first_per_key(fresh, keys, others or list(keys)))


def merge_rows(target: DataFrame, updates: DataFrame, key: str, set_columns: Sequence[str]) -> DataFrame:
    """MERGE: update some columns of matching rows, insert the others with NULL in the rest.

    `updates` must hold each key once, otherwise the query fails. The target meets the updates in a left join;
    the keys to insert are found among the updates alone.
    """
    updates = one_per_key(updates.select(key, *set_columns), [key])
    new = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in set_columns], F.lit(True).alias("_hit"))
    matched = target.join(new, F.col(key) == F.col("_key"), "left").select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in set_columns else F.col(c) for c in target.columns]
    )
    known = target.select(key).join(updates.select(key), key, "left_semi")
    inserted = updates.join(known, key, "left_anti").select(key, *set_columns)
    return matched.unionByName(inserted, allowMissingColumns=True).select(target.columns)


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """UPDATE .. SET .. WHERE as a rewrite; rows where the condition is NULL stay."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[F.when(condition, changes[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE .. WHERE as a rewrite; rows where the condition is NULL stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def incremental_by_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], at: str, target_at: str, aggregates: Sequence[Column], mode: str = "full_keys"
) -> DataFrame:
    """Refresh a per-key aggregate from the rows that arrived since the last load.

    `full_keys` recomputes the keys that have new rows from all their rows.
    `new_rows` aggregates the new rows alone and replaces the key with that,
    which is what a plain incremental model with a unique key does. An empty
    target is loaded in full.
    """
    if mode not in ("full_keys", "new_rows"):
        raise ValueError(f"unknown mode {mode!r}")
    last = target.agg(F.max(target_at)).scalar()
    fresh = source.where(F.coalesce(F.col(at) > last, last.isNull()))
    rows = source.join(fresh.select(*keys).distinct(), list(keys), "left_semi") if mode == "full_keys" else fresh
    return upsert(target, rows.groupBy(*keys).agg(*aggregates), keys)


def incremental_by_day(
    target: DataFrame, source: DataFrame, keys: Sequence[str], day: str, aggregates: Sequence[Column], late_rows: bool = True
) -> DataFrame:
    """Refresh a per-(key, day) aggregate from the last loaded day on.

    With `late_rows` the last loaded day is rebuilt as well; without, rows that
    arrive late for that day are missed. An empty target is loaded in full.
    """
    last = target.agg(F.max(day)).scalar()
    newer = F.col(day) >= last if late_rows else F.col(day) > last
    fresh = source.where(F.coalesce(newer, last.isNull())).groupBy(*keys, day).agg(*aggregates)
    return upsert(target, fresh, [*keys, day])


def missing_dates(log: DataFrame, day: str, lo: str | Column, hi: str | Column, done: Column | None = None) -> DataFrame:
    """Dates of a range without a finished run in the log.

    `lo` and `hi` are dates or aggregates over the whole log; `done` tells the
    rows that count (step and status), so that a gap at the end, up to a
    finalized date, is seen too.
    """
    ends = log.agg(*[e.alias(n) if isinstance(e, Column) else F.lit(e).cast("date").alias(n) for e, n in ((lo, "lo"), (hi, "hi"))])
    wanted = ends.select(F.explode(days("lo", "hi")).alias("missing_date"))
    finished = (log if done is None else log.where(done)).select(F.col(day).cast("date").alias("_done")).distinct()
    return wanted.join(finished, F.col("missing_date") == F.col("_done"), "left_anti")


def first_missing_date(log: DataFrame, day: str, lo: str | Column, hi: str | Column, done: Column | None = None) -> DataFrame:
    return missing_dates(log, day, lo, hi, done).agg(F.min("missing_date").alias("next_date"))


def check_date_range(start: dt.date, end: dt.date, first: dt.date, last: dt.date) -> None:
    """Refuse a backfill outside what the source offers."""
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    if start < first or end > last:
        raise ValueError(f"{start}..{end} is outside the source range {first}..{last}")


def backfill(build: DataFrame, table: DayTable, start: dt.date, end: dt.date) -> int:
    """Rebuild the days of a range in one step; running it again gives the same table.

    Days of the range without rows end empty. A range that reaches outside the
    days of the source is refused, and so is a source without rows. Readers see
    the days as they were until all of them are written.
    """
    span = build.agg(F.min(table.day).alias("first"), F.max(table.day).alias("last")).first()
    if span["first"] is None:
        raise ValueError("the source has no rows, so there is nothing to rebuild from")
    check_date_range(start, end, span["first"], span["last"])
    return replace_days(table, build, start, end)


def append_run(spark: SparkSession, path: str, run_id: str, step: str, logical_date: dt.date, attempt: int, status: str, rows: int, started: dt.datetime, message: str = "") -> None:
    """One line of the run log, in a folder of its own so that a retry replaces it."""
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(step).alias("step_name"),
        F.lit(logical_date).alias("logical_date"),
        F.lit(attempt).cast("bigint").alias("attempt_no"),
        F.lit(status).alias("status"),
        F.lit(rows).cast("bigint").alias("rows_loaded"),
        F.lit(message).alias("message"),
        F.lit(started).alias("started_at"),
        F.current_timestamp().alias("finished_at"),
    )
    row.write.mode("overwrite").parquet(f"{path}/entry={run_id}_{step}_{attempt}")


def write_logged(df: DataFrame, path: str, log_path: str, run_id: str, step: str, logical_date: dt.date, attempt: int = 1) -> int:
    """Write a table and log the rows written, counted during the write itself."""
    from pyspark.sql import Observation

    started = dt.datetime.now(dt.timezone.utc)
    seen = Observation(f"{step}-{run_id}-{attempt}")
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    except Exception as error:
        append_run(df.sparkSession, log_path, run_id, step, logical_date, attempt, "error", 0, started, str(error))
        raise
    rows = seen.get["rows"]
    append_run(df.sparkSession, log_path, run_id, step, logical_date, attempt, "success", rows, started)
    return rows


def log_skipped(spark: SparkSession, log_path: str, run_id: str, step: str, logical_date: dt.date, reason: str, attempt: int = 1) -> None:
    """Log a step that was not run because its date is done already or not final yet."""
    append_run(spark, log_path, run_id, step, logical_date, attempt, "skipped", 0, dt.datetime.now(dt.timezone.utc), reason)


def latest_status(log: DataFrame, step: str, order: Sequence[Column]) -> DataFrame:
    return first_per_key(log, [step], order)


def visible_as_of(df: DataFrame, updated_at: str, now: str | Column) -> DataFrame:
    """Rows that existed at a business time."""
    return df.where(F.col(updated_at) <= (F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now))


def key_gate(rows: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Pass the rows on only if every key has a member; otherwise stop with an example."""
    from strataloom.operators.joins import orphans

    if (missing := orphans(rows, dim, key, dim_key).select(key).limit(1).collect()):
        raise ValueError(f"{key} without a member in the dimension, e.g. {missing[0][0]!r}")
    return rows


def write_version(df: DataFrame, root: str, version: int) -> DataFrame:
    """Publish a table version in its own folder; earlier versions stay readable."""
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
    return read_version(df.sparkSession, root, version)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/v={version}")


def read_as_of(changes: DataFrame, keys: Sequence[str], version: str, wanted, operation: str, order: Sequence[Column], deleted: str = "delete") -> DataFrame:
    """Table state at a version of an append-only change log."""
    upto = changes.where(F.col(version) <= wanted)
    latest = first_per_key(upto, keys, [F.col(version).desc(), *order])
    return latest.where(F.col(operation) != deleted)


def version_history(changes: DataFrame, version: str, weight: Column, operation: str) -> DataFrame:
    """Per version: operations, net change and running row count.

    The log is reduced to one row per version before the running sum.
    """
    per_version = changes.groupBy(version).agg(
        F.array_join(F.array_sort(F.collect_set(operation)), ",").alias("operations"),
        F.count(F.lit(1)).alias("changed_rows"),
        F.sum(weight).cast("bigint").alias("net_change"),
    )
    upto = Window.orderBy(version).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_version.withColumn("row_count", F.sum("net_change").over(upto))


def add_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Additive schema change with a value for the old rows."""
    return df.withColumn(name, value)


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of different age as one table; columns missing from old files are NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)
