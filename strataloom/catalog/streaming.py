"""Streams over the events table, run until the input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.catalog.registry import query, sql_round
from strataloom.functions import numbers
from strataloom.operators.aggregates import same_rows
from strataloom.session import new_dir
from strataloom.sources.versioned import DayTable
from strataloom.streaming import event_time as et
from strataloom.streaming import file_streams as st


def _stream(t):
    return st.read_stream(t.spark, t.stream_path("events"), t.events.schema)


def purchases(events):
    """Row-by-row transformation that works on batches and streams alike."""
    return events.where("event_type = 'purchase' AND value > 0").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), numbers.round_half_up(F.col("value") * 1.2, 2).alias("gross"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


SQL_PURCHASES = f"""
    SELECT event_id, user_id, CAST(ts AS DATE) AS day, {sql_round('value * 1.2', 2)} AS gross, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events WHERE event_type = 'purchase' AND value > 0
"""


@query("r01_stream_transform", SQL_PURCHASES)
def r01(t):
    root = new_dir(t.spark, "r01")
    st.run_to_files(purchases(_stream(t)), f"{root}/data", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/data")


@query("r02_stream_sink", "SELECT event_id, event_type, value, CAST(ts AS DATE) AS day FROM events")
def r02(t):
    root = new_dir(t.spark, "r02")
    rows = _stream(t).select("event_id", "event_type", "value", F.to_date("ts").alias("day"))
    st.run_keyed(rows, f"{root}/data", f"{root}/checkpoint", "event_id", "day")
    return t.spark.read.schema(rows.schema).parquet(f"{root}/data")


@query("r03_replay", SQL_PURCHASES)
def r03(t):
    """The whole input is delivered twice, under two checkpoints."""
    root = new_dir(t.spark, "r03")
    rows = purchases(_stream(t))
    for attempt in (1, 2):
        st.run_keyed(rows, f"{root}/data", f"{root}/checkpoint{attempt}", "event_id", "day")
    return t.spark.read.schema(rows.schema).parquet(f"{root}/data").select(rows.columns)


@query(
    "r04_fan_out",
    """
    SELECT 'errors' AS subscriber, event_id, user_id FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'large', event_id, user_id FROM events WHERE value > 50
    """,
)
def r04(t):
    subscribers = {
        "errors": lambda s: s.where("event_type = 'error'").select(F.lit("errors").alias("subscriber"), "event_id", "user_id"),
        "large": lambda s: s.where("value > 50").select(F.lit("large").alias("subscriber"), "event_id", "user_id"),
    }
    targets = st.fan_out(t.spark, t.stream_path("events"), t.events.schema, subscribers, new_dir(t.spark, "r04"))
    return t.spark.read.parquet(*targets.values())


@query("r05_parity", f"SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS differing_rows FROM ({SQL_PURCHASES})")
def r05(t):
    root = new_dir(t.spark, "r05")
    st.run_to_files(purchases(_stream(t)), f"{root}/data", f"{root}/checkpoint")
    batch = purchases(t.events)
    streamed = t.spark.read.schema(batch.schema).parquet(f"{root}/data")
    differing = same_rows(streamed, batch).agg(F.count("*").alias("n")).scalar()
    return streamed.agg(F.count("*").alias("row_count")).withColumn("differing_rows", differing)


# Event time -------------------------------------------------------------------

LATENESS_HOURS = 1
SLICES = 4  # deliveries of the events, in the order of their ids


def _delivered(t, rows, label: str, deliveries, after_each) -> None:
    """Write the rows in several deliveries into one folder and call `after_each` behind every one."""
    path = new_dir(t.spark, label)
    for i, wanted in enumerate(deliveries):
        rows.where(wanted).write.mode("append").parquet(path)
        after_each(path, i)


def _sliced(t):
    """Events with the slice that their id falls into and the delivery they come with: of the first half every 25th comes two deliveries late."""
    top = t.events.agg(F.max("event_id")).scalar()
    piece = F.floor(F.col("event_id") * SLICES / (top + 1)).cast("int")
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("slice", piece)
    return events.withColumn("delivery", F.when((F.col("event_id") % 25 == 3) & (F.col("slice") < SLICES - 2), F.col("slice") + 2).otherwise(F.col("slice")))


SQL_SLICED = f"""
    sliced AS (
      SELECT *, CASE WHEN event_id % 25 = 3 AND slice < {SLICES - 2} THEN slice + 2 ELSE slice END AS delivery
      FROM (SELECT *, event_id * {SLICES} // (SELECT MAX(event_id) + 1 FROM events) AS slice FROM events)),
    marks AS (
      SELECT d.delivery, (SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL {LATENESS_HOURS} HOUR FROM sliced s WHERE s.delivery < d.delivery) AS mark
      FROM (SELECT DISTINCT delivery FROM sliced) d)
"""


@query(
    "r01_event_windows",
    f"""
    SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, event_type, COUNT(*) AS row_count,
           time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= (SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL {LATENESS_HOURS} HOUR FROM events) AS is_closed
    FROM events GROUP BY ALL
    """,
)
def r01_windows(t):
    """Windows that the watermark has closed, from the sink, and those still open, from the state store."""
    root = new_dir(t.spark, "r01w")
    windows = et.tumbling(_stream(t), "ts", "6 hours", ["event_type"], lateness=f"{LATENESS_HOURS} hours")
    et.run_closed(windows, f"{root}/data", f"{root}/checkpoint")
    closed = t.spark.read.schema(windows.schema).parquet(f"{root}/data").withColumn("is_closed", F.lit(True))
    waiting = et.open_windows(t.spark, f"{root}/checkpoint", ["event_type"]).withColumn("is_closed", F.lit(False))
    return _local(closed.unionByName(waiting))


def _local(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query(
    "r01_late_windows",
    f"""
    WITH {SQL_SLICED}
    SELECT window_start, window_end, event_type, COUNT(*) AS row_count, COUNT(*) FILTER (is_late) AS late_count FROM (
      SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, event_type,
             COALESCE(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= mark, FALSE) AS is_late
      FROM sliced JOIN marks USING (delivery))
    GROUP BY ALL
    """,
)
def r01_late(t):
    """Events in four deliveries, some far too late: every window with all its rows and the number that came after it was closed."""
    root, by = new_dir(t.spark, "r01l"), ["window_start", "window_end", "event_type"]
    rows = _sliced(t)

    def count(path, _):
        stream = st.read_stream(t.spark, path, rows.schema)
        et.run_closed(et.tumbling(stream, "ts", "6 hours", ["event_type"], lateness=f"{LATENESS_HOURS} hours"), f"{root}/data", f"{root}/checkpoint")

    _delivered(t, rows, "r01in", [F.col("delivery") == i for i in range(SLICES)], count)
    everything = et.tumbling(rows, "ts", "6 hours", ["event_type"])
    closed = t.spark.read.schema(everything.schema).parquet(f"{root}/data")
    streamed = closed.unionByName(et.open_windows(t.spark, f"{root}/checkpoint", ["event_type"]))
    late = et.late_rows(everything, streamed, by)
    return _local(everything.join(late, by, "left").withColumn("late_count", F.coalesce("late_count", F.lit(0))))


@query(
    "r02_sessions",
    f"""
    SELECT user_id, MIN(ts) AS window_start, MAX(ts) + INTERVAL 8 HOUR AS window_end, COUNT(*) AS row_count,
           MAX(ts) + INTERVAL 8 HOUR <= (SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL {LATENESS_HOURS} HOUR FROM events) AS is_closed
    FROM (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
      SELECT *, CASE WHEN ts < LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
    GROUP BY user_id, session
    """,
)
def r02_sessions(t):
    """Sessions of users, which end after eight quiet hours; closed ones from the sink, open ones from the state store."""
    root = new_dir(t.spark, "r02s")
    windows = et.sessions(_stream(t), "ts", "8 hours", ["user_id"], lateness=f"{LATENESS_HOURS} hours")
    et.run_closed(windows, f"{root}/data", f"{root}/checkpoint")
    closed = t.spark.read.schema(windows.schema).parquet(f"{root}/data").withColumn("is_closed", F.lit(True))
    waiting = et.open_sessions(t.spark, f"{root}/checkpoint", ["user_id"]).withColumn("is_closed", F.lit(False))
    return _local(closed.unionByName(waiting))


@query("r03_bounded", "SELECT event_id, user_id, event_type, value FROM events")
def r03_bounded(t):
    """Every delivery repeats the one before it; keys are remembered for a day of event time only."""
    root = new_dir(t.spark, "r03b")
    # what no later step reads is neither delivered nor dealt by key
    rows = _sliced(t).select("event_id", "user_id", "event_type", "value", "ts", "slice")
    wanted = rows.drop("slice").schema

    def run(path, _):
        stream = et.without_repeats(st.read_stream(t.spark, path, wanted), ["event_id"], "ts", "1 day")
        st.run_to_files(stream, f"{root}/data", f"{root}/checkpoint")

    _delivered(t, rows, "r03in", [F.col("slice").isin(i, i - 1) for i in range(SLICES)], run)
    return t.spark.read.schema(wanted).parquet(f"{root}/data").select("event_id", "user_id", "event_type", "value")


@query(
    "r03_upsert",
    f"""
    SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 = 0 THEN {sql_round('value * 2', 2)} WHEN event_id % 3 = 1 THEN {sql_round('value * 4', 2)} ELSE value END AS value,
           CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 0 END AS version
    FROM events
    """,
)
def r03_upsert(t):
    """Changed rows of known keys replace the older ones; versions arrive out of order and the whole input is replayed."""
    root = new_dir(t.spark, "r03u")
    first = t.events.select("event_id", F.to_date("ts").alias("day"), "value", F.lit(0).alias("version"))

    def changed(rest, version, factor):
        return first.where(F.col("event_id") % 3 == rest).withColumns({"value": numbers.round_half_up(F.col("value") * factor, 2), "version": F.lit(version)})

    deliveries = [changed(1, 3, 4), first, changed(0, 1, 2).unionByName(changed(1, 2, 3))]
    source = new_dir(t.spark, "r03changes")
    table = DayTable(t.spark, f"{root}/table", "day", first.schema)
    for rows in deliveries:
        rows.write.mode("append").parquet(source)
        st.run_upserts(st.read_stream(t.spark, source, first.schema), table, f"{root}/checkpoint", "event_id", "version")
    st.run_upserts(st.read_stream(t.spark, source, first.schema), table, f"{root}/replay", "event_id", "version")
    return table.read()
