"""Event-time streams: windows and sessions with a watermark, and duplicates forgotten in time.

State lives in Spark's state store and is dropped as the watermark passes: a
window is written once, when no row within the allowed lateness can reach it any
more. Rows that come later than that do not count in it. They are not lost
silently: what is written, what is still open in the state store and what the
source holds are compared per window or key, and the difference is the number
of late rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "row_count"


def tumbling(rows: DataFrame, time: str, width: str, by: Sequence[str] = (), sums: Sequence[str] = (), lateness: str | None = None) -> DataFrame:
    """Rows and sums per window of `width` and key: window_start, window_end, keys, row_count, sums.

    Sums are of whole or decimal columns, so that they do not depend on the
    order of addition. On a stream `lateness` sets the watermark; on a batch it
    is not needed.
    """
    return _ends(_timed(rows, time, lateness).groupBy(F.window(time, width).alias("_span"), *by).agg(*_aggregates(sums)), by, sums)


def sessions(rows: DataFrame, time: str, gap: str, by: Sequence[str], sums: Sequence[str] = (), lateness: str | None = None) -> DataFrame:
    """Rows and sums per session, which ends when a key has no row for `gap`.

    Batches and streams agree on all rows that are no later than the watermark.
    """
    return _ends(_timed(rows, time, lateness).groupBy(F.session_window(time, gap).alias("_span"), *by).agg(*_aggregates(sums)), by, sums)


def _timed(rows: DataFrame, time: str, lateness: str | None) -> DataFrame:
    """Watermarks need instants; local times count as those of the session's zone."""
    if dict(rows.dtypes)[time] != "timestamp":
        rows = rows.withColumn(time, F.col(time).cast("timestamp"))
    return rows.withWatermark(time, lateness) if lateness else rows


def _aggregates(sums: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias(ROWS), *[F.sum(c).alias(c) for c in sums]]


def _ends(grouped: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return grouped.select(F.col("_span.start").alias("window_start"), F.col("_span.end").alias("window_end"), *by, ROWS, *sums)


def run_closed(windows: DataFrame, target: str, checkpoint: str) -> list[dict]:
    """Write the windows that close while the input available is read; returns the progress of its batches.

    The file sink's log and the checkpoint make a run that is repeated or broken
    off write each window once.
    """
    query = (
        windows.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return [dict(p) if isinstance(p, dict) else p.jsonValue for p in query.recentProgress]


def state_rows(progress: Sequence[dict]) -> list[int]:
    """Rows that the state store held after each batch."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress]


def open_windows(spark: SparkSession, checkpoint: str, by: Sequence[str]) -> DataFrame:
    """Windows that wait in the state store of a `tumbling` stream: window_start, window_end, keys, row_count."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    keys = state.schema["key"].dataType.names
    span = F.col("key").getField(keys[0])
    return state.select(
        span["start"].alias("window_start"), span["end"].alias("window_end"), *[F.col("key").getField(k).alias(k) for k in by], F.col("value.count").alias(ROWS)
    )


def open_sessions(spark: SparkSession, checkpoint: str, by: Sequence[str]) -> DataFrame:
    """Sessions that wait in the state store of a `sessions` stream: window_start, window_end, keys, row_count."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    span = next(f.name for f in state.schema["value"].dataType if f.dataType.typeName() == "struct")
    return state.select(
        F.col("value").getField(span)["start"].alias("window_start"), F.col("value").getField(span)["end"].alias("window_end"),
        *[F.col("value").getField(k).alias(k) for k in by], F.col("value.count").alias(ROWS),
    )


def late_rows(expected: DataFrame, streamed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with rows that came too late, and their number: keys, late_count.

    `expected` counts the source (row_count per key), `streamed` the closed and
    open windows. Both sides are added up by key before they meet.
    """
    signed = expected.select(*keys, F.col(ROWS)).unionByName(streamed.select(*keys, (-F.col(ROWS)).alias(ROWS)))
    return signed.groupBy(*keys).agg(F.sum(ROWS).alias("late_count")).where("late_count > 0")


def without_repeats(rows: DataFrame, key: Sequence[str], time: str, lateness: str) -> DataFrame:
    """The first row of each key; a key is remembered until the watermark has passed its row by `lateness`.

    A repeated delivery carries its row's time. One that comes after its key was
    forgotten is later than the watermark and dropped for that, so nothing is
    written twice, and the state holds no more than the keys of that time.
    """
    return _timed(rows, time, lateness).dropDuplicatesWithinWatermark(list(key))
