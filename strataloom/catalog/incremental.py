"""Incremental loads, rewrites of rows, versions and table upkeep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strataloom.catalog.registry import query, sql_mean, sql_round, sql_total
from strataloom.catalog.sourcing import write_lines_by_month
from strataloom.functions import numbers
from strataloom.operators.aggregates import same_rows
from strataloom.operators.joins import pruned_by
from strataloom.plans import incremental as inc
from strataloom.session import new_dir
from strataloom.sources import sinks
from strataloom.sources.versioned import DayTable

CUT = "2024-01-16"


def _before_cut():
    return F.col("ts") < F.lit(CUT).cast("timestamp_ntz")


def _user_stats():
    return [F.count("*").alias("event_count"), numbers.mean("value").alias("avg_value"), F.max("ts").alias("last_ts")]


SQL_USER_STATS = f"SELECT user_id, COUNT(*) AS event_count, {sql_mean('value')} AS avg_value, MAX(ts) AS last_ts FROM events"


def _first_batch(t):
    return t.events.where(_before_cut()).groupBy("user_id").agg(*_user_stats())


@query("i01_incremental", f"{SQL_USER_STATS} GROUP BY 1")
def i01(t):
    return inc.incremental_by_key(_first_batch(t), t.events, ["user_id"], "ts", "last_ts", _user_stats())


@query(
    "i01_new_rows_only",
    f"""
    WITH old AS ({SQL_USER_STATS} WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1),
         new AS ({SQL_USER_STATS} WHERE ts > (SELECT MAX(last_ts) FROM old) GROUP BY 1)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM new)
    """,
)
def i01_new(t):
    return inc.incremental_by_key(_first_batch(t), t.events, ["user_id"], "ts", "last_ts", _user_stats(), mode="new_rows")


@query("i01_first_load", f"{SQL_USER_STATS} GROUP BY 1")
def i01_first(t):
    """From an empty target: the first run loads everything."""
    return inc.incremental_by_key(_first_batch(t).where(F.lit(False)), t.events, ["user_id"], "ts", "last_ts", _user_stats())


def _daily(rows):
    return rows.select("user_id", F.to_date("ts").alias("day"), "value")


def _day_stats():
    return [F.count("*").alias("event_count"), numbers.total("value").alias("total_value")]


SQL_DAY_STATS = f"SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS event_count, {sql_total('value')} AS total_value FROM events GROUP BY ALL"


def _incremental_days(t):
    """The first load ends in the middle of a day, so that day has late rows."""
    half_day = F.col("ts") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    loaded = _daily(t.events.where(half_day)).groupBy("user_id", "day").agg(*_day_stats())
    return inc.incremental_by_day(loaded, _daily(t.events), ["user_id"], "day", _day_stats())


@query("i02_incremental_daily", SQL_DAY_STATS)
def i02(t):
    return _incremental_days(t)


@query("i02_first_load", SQL_DAY_STATS)
def i02_first(t):
    empty = _daily(t.events.where(F.lit(False))).groupBy("user_id", "day").agg(*_day_stats())
    return inc.incremental_by_day(empty, _daily(t.events), ["user_id"], "day", _day_stats())


@query("i03_full_refresh", f"SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS differing_rows FROM ({SQL_DAY_STATS})")
def i03(t):
    full = _daily(t.events).groupBy("user_id", "day").agg(*_day_stats())
    differing = same_rows(_incremental_days(t), full).agg(F.count("*").alias("n")).scalar()
    return full.agg(F.count("*").alias("row_count")).withColumn("differing_rows", differing)


@query("i04_batches", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def i04(t):
    """Two id ranges that overlap in the middle third; the overlap is not loaded twice."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    top = rows.agg(F.max("o_orderkey").alias("top"))
    first = rows.where(F.col("o_orderkey") * 3 <= top.select(F.col("top") * 2).scalar())
    second = rows.where(F.col("o_orderkey") * 3 > top.scalar())
    return inc.insert_if_absent(first, second, ["o_orderkey"])


SQL_MISSING = """
    SELECT day AS missing_date FROM (SELECT CAST(UNNEST(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders
      WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
    WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
"""


def _log(t):
    return t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")


def _ends():
    d = F.col("o_orderdate").cast("date")
    return F.min(d), F.max(d)


@query("i05_missing_dates", SQL_MISSING)
def i05(t):
    return inc.missing_dates(_log(t), "o_orderdate", *_ends())


@query("i05_next_missing", f"SELECT MIN(missing_date) AS next_date FROM ({SQL_MISSING})")
def i05_next(t):
    return inc.first_missing_date(_log(t), "o_orderdate", *_ends())


SQL_STEP_LOG = """
    SELECT o_orderpriority AS step, CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'error' ELSE 'skipped' END AS status FROM orders
"""


@query(
    "i05_gap_of_a_step",
    f"""
    SELECT CAST(day AS DATE) AS missing_date FROM (SELECT UNNEST(generate_series((SELECT MIN(day) FROM log), (SELECT MAX(day) FROM log), INTERVAL 1 DAY)) AS day)
    WHERE day NOT IN (SELECT day FROM log WHERE step = '2-HIGH' AND status = 'success')
    """.replace("FROM log", f"FROM ({SQL_STEP_LOG})"),
)
def i05_step(t):
    """Gaps of one step up to the last finalized date of the whole log, the end included."""
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "error").otherwise("skipped")
    log = t.orders.select(F.col("o_orderpriority").alias("step"), F.to_date("o_orderdate").alias("day"), status.alias("status"))
    return inc.missing_dates(log, "day", F.min("day"), F.max("day"), done=(F.col("step") == "2-HIGH") & (F.col("status") == "success"))


@query(
    "i06_emptied_day",
    "SELECT CAST(ts AS DATE) AS day, COUNT(*) AS event_count FROM events WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-06', DATE '2024-01-08') GROUP BY 1",
)
def i06_emptied(t):
    """Two days of the range have lost their rows in the source; both end empty, also when run again."""
    path = new_dir(t.spark, "i06empty")
    rows = t.events.select("event_id", "value", F.to_date("ts").alias("day"))
    table = DayTable(t.spark, path, "day", rows.schema)
    table.replace(rows)
    left = rows.where(~F.col("day").isin(dt.date(2024, 1, 6), dt.date(2024, 1, 8)))
    for _ in range(2):
        inc.backfill(left, table, dt.date(2024, 1, 5), dt.date(2024, 1, 10))
    return table.read().groupBy("day").agg(F.count("*").alias("event_count"))


@query(
    "i06_backfill",
    f"SELECT event_id, {sql_round('value * 2', 2)} AS value, CAST(ts AS DATE) AS day FROM events WHERE ts < TIMESTAMP '2024-01-11' AND ts >= TIMESTAMP '2024-01-05' UNION ALL "
    "SELECT event_id, value, CAST(ts AS DATE) FROM events WHERE NOT (ts < TIMESTAMP '2024-01-11' AND ts >= TIMESTAMP '2024-01-05')",
)
def i06(t):
    path = new_dir(t.spark, "i06")
    rows = t.events.select("event_id", "value", F.to_date("ts").alias("day"))
    table = DayTable(t.spark, path, "day", rows.schema)
    table.replace(rows)
    rebuilt = rows.withColumn("value", numbers.round_half_up(F.col("value") * 2, 2))
    for _ in range(2):
        inc.backfill(rebuilt, table, dt.date(2024, 1, 5), dt.date(2024, 1, 10))
    return table.read()


@query(
    "i08_run_log",
    """
    SELECT step_name, DATE '2024-01-31' AS logical_date, CAST(1 AS BIGINT) AS attempt_no, 'success' AS status, rows_loaded
    FROM (SELECT 'load_orders' AS step_name, COUNT(*) AS rows_loaded FROM orders UNION ALL SELECT 'load_events', COUNT(*) FROM events)
    """,
)
def i08(t):
    log = new_dir(t.spark, "i08log")
    for step, df in (("load_orders", t.orders), ("load_events", t.events)):
        inc.write_logged(df, new_dir(t.spark, "i08data"), log, "run-1", step, dt.date(2024, 1, 31))
    columns = ["step_name", "logical_date", "attempt_no", "status", "rows_loaded"]
    return t.spark.read.parquet(log).where(F.col("finished_at") >= F.col("started_at")).select(*columns)


SQL_LOG = "SELECT event_type AS step_name, user_id AS run_id, event_id, ts, CASE WHEN value > 100 THEN 'error' ELSE 'success' END AS status FROM events"


def _event_log(t):
    status = F.when(F.col("value") > 100, "error").otherwise("success")
    return t.events.select(F.col("event_type").alias("step_name"), F.col("user_id").alias("run_id"), "event_id", "ts", status.alias("status"))


@query(
    "i08_skipped",
    """
    SELECT 'load_orders' AS step_name, 'success' AS status, COUNT(*) AS rows_loaded, '' AS message FROM orders
    UNION ALL SELECT 'load_parts', 'skipped', 0, CAST(COUNT(*) AS VARCHAR) || ' rows are there already' FROM part
    """,
)
def i08_skipped(t):
    """A step whose table is there already is logged as skipped."""
    log = new_dir(t.spark, "i08log")
    inc.write_logged(t.orders, new_dir(t.spark, "i08data"), log, "run-2", "load_orders", dt.date(2024, 2, 1))
    inc.log_skipped(t.spark, log, "run-2", "load_parts", dt.date(2024, 2, 1), f"{t.part.count()} rows are there already")
    return t.spark.read.parquet(log).select("step_name", "status", "rows_loaded", "message")


@query(
    "i09_log_latest",
    f"SELECT step_name, event_id, ts, status FROM ({SQL_LOG}) QUALIFY ROW_NUMBER() OVER (PARTITION BY step_name ORDER BY ts DESC, event_id DESC) = 1",
)
def i09(t):
    return inc.latest_status(_event_log(t), "step_name", [F.desc("ts"), F.desc("event_id")]).select("step_name", "event_id", "ts", "status")


@query(
    "i09_attempts",
    f"""
    SELECT run_id, step_name, COUNT(*) AS attempts, COUNT(*) FILTER (status = 'error') AS errors,
           CAST(epoch(date_trunc('second', MAX(ts))) - epoch(date_trunc('second', MIN(ts))) AS BIGINT) AS seconds
    FROM ({SQL_LOG}) GROUP BY ALL
    """,
)
def i09_attempts(t):
    from strataloom.functions.dates import seconds_between

    return _event_log(t).groupBy("run_id", "step_name").agg(
        F.count("*").alias("attempts"),
        F.count_if(F.col("status") == "error").alias("errors"),
        seconds_between(F.min("ts"), F.max("ts")).alias("seconds"),
    )


@query("i10_visible", "SELECT event_id, user_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'")
def i10(t):
    return inc.visible_as_of(t.events, "ts", "2024-01-15 12:00:00").select("event_id", "user_id", "ts")


@query(
    "i11_key_gate",
    f"SELECT c_mktsegment, {sql_total('o_totalprice')} AS sales FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
)
def i11(t):
    """Orders are summed per customer first; gate and join see one row per customer."""
    per_customer = t.orders.groupBy("o_custkey").agg(numbers.exact_sum("o_totalprice").alias("sum"))
    gated = inc.key_gate(per_customer, t.customer, "o_custkey", "c_custkey")
    joined = gated.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("sum").cast("double").alias("sales"))


@query(
    "i12_merge",
    f"""
    SELECT p_partkey, p_name, p_brand, p_type, p_size, CASE WHEN p_type = 'PROMO' THEN {sql_round('p_retailprice * 0.9', 2)} ELSE p_retailprice END AS p_retailprice FROM part
    UNION ALL SELECT s_suppkey + (SELECT MAX(p_partkey) + 1 FROM part), NULL, NULL, NULL, NULL, s_acctbal FROM supplier
    """,
)
def i12(t):
    promo = t.part.where("p_type = 'PROMO'").select("p_partkey", numbers.round_half_up(F.col("p_retailprice") * 0.9, 2).alias("p_retailprice"))
    shift = t.part.agg(F.max("p_partkey") + 1).scalar()
    new = t.supplier.select((F.col("s_suppkey") + shift).alias("p_partkey"), F.col("s_acctbal").alias("p_retailprice"))
    return inc.merge_rows(t.part, promo.union(new), "p_partkey", ["p_retailprice"])


@query(
    "i13_update",
    f"""
    SELECT o_orderkey, CASE WHEN NULLIF(o_orderstatus, 'P') = 'O' THEN 'closed' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN NULLIF(o_orderstatus, 'P') = 'O' THEN {sql_round('o_totalprice * 1.1', 2)} ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def i13(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    raised = numbers.round_half_up(F.col("o_totalprice") * 1.1, 2)
    condition = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "O"
    return inc.update_where(rows, condition, {"o_orderstatus": F.lit("closed"), "o_totalprice": raised})


@query("i14_delete", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT COALESCE(NULLIF(o_orderstatus, 'P') = 'O', FALSE)")
def i14(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return inc.delete_where(rows, F.nullif(F.col("o_orderstatus"), F.lit("P")) == "O")


def _changes(t):
    operation = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "signup", "insert").otherwise("update")
    return t.events.select("user_id", "event_id", "value", F.dayofmonth("ts").cast("bigint").alias("version"), operation.alias("operation"))


SQL_CHANGES = """
    SELECT user_id, event_id, value, CAST(day(ts) AS BIGINT) AS version,
           CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS operation FROM events
"""


@query(
    "i15_as_of",
    f"""
    SELECT user_id, event_id, value, version FROM (
      SELECT * FROM ({SQL_CHANGES}) WHERE version <= 15
      QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY version DESC, event_id DESC) = 1) WHERE operation <> 'delete'
    """,
)
def i15(t):
    state = inc.read_as_of(_changes(t), ["user_id"], "version", 15, "operation", [F.desc("event_id")])
    return state.select("user_id", "event_id", "value", "version")


@query("i15_table_version", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def i15_version(t):
    """Three published versions of a table, read back at the second one."""
    root = new_dir(t.spark, "i15")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = inc.write_version(rows, root, 1)
    second = inc.write_version(inc.delete_where(first, F.col("o_orderstatus") == "P"), root, 2)
    inc.write_version(inc.update_where(second, F.col("o_totalprice") > 0, {"o_totalprice": F.lit(0.0)}), root, 3)
    return inc.read_version(t.spark, root, 2).select("o_orderkey", "o_totalprice")


@query(
    "i16_version_counts",
    f"""
    SELECT *, CAST(SUM(net_change) OVER (ORDER BY version) AS BIGINT) AS row_count FROM (
      SELECT version, STRING_AGG(DISTINCT operation, ',' ORDER BY operation) AS operations, COUNT(*) AS changed_rows,
             CAST(SUM(CASE operation WHEN 'insert' THEN 1 WHEN 'delete' THEN -1 ELSE 0 END) AS BIGINT) AS net_change
      FROM ({SQL_CHANGES}) GROUP BY 1)
    """,
)
def i16(t):
    weight = F.when(F.col("operation") == "insert", 1).when(F.col("operation") == "delete", -1).otherwise(0)
    return inc.version_history(_changes(t), "version", weight, "operation")


@query(
    "i17_compact",
    f"SELECT l_returnflag, COUNT(*) AS line_count, {sql_total('l_extendedprice')} AS gross FROM lineitem GROUP BY 1",
)
def i17(t):
    scattered, compacted = new_dir(t.spark, "i17small"), new_dir(t.spark, "i17large")
    t.lineitem.repartition(32).write.parquet(scattered)
    sinks.compact(t.spark, scattered, compacted)
    rows = t.spark.read.parquet(compacted)
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("line_count"), numbers.total("l_extendedprice").alias("gross"))


@query(
    "i17_compact_partitions",
    f"""
    SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, COUNT(*) AS line_count, TRUE AS one_file FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY 1
    """,
)
def i17_partitions(t):
    """A table by month keeps its folders, and each small folder becomes one file."""
    large = new_dir(t.spark, "i17months")
    sinks.compact(t.spark, write_lines_by_month(t, "i17"), large, by=["ship_year", "ship_month"])
    layout = sinks.partition_layout(t.spark.read.parquet(large).where("ship_year = 1997"), ["ship_month"])
    return layout.select("ship_month", F.col("row_count").alias("line_count"), (F.col("file_count") == 1).alias("one_file"))


@query(
    "i18_add_column",
    f"""
    SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'web' ELSE lower(o_orderpriority) END AS channel, COUNT(*) AS order_count,
           {sql_total('o_totalprice')} AS sales
    FROM orders GROUP BY 1
    """,
)
def i18(t):
    """Old files lack the column; the merged read gives NULL, which is filled before the mart is rebuilt."""
    old_path, new_path = new_dir(t.spark, "i18old"), new_dir(t.spark, "i18new")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    rows.where(early).drop("o_orderpriority").write.parquet(old_path)
    inc.add_column(rows.where(~early), "channel", F.lower("o_orderpriority")).drop("o_orderpriority").write.parquet(new_path)
    merged = inc.read_merged(t.spark, old_path, new_path)
    filled = merged.withColumn("channel", F.coalesce("channel", F.lit("web")))
    return filled.groupBy("channel").agg(F.count("*").alias("order_count"), numbers.total("o_totalprice").alias("sales"))


@query(
    "i19_pruned",
    f"""
    SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, COUNT(*) AS line_count, {sql_total('l_extendedprice')} AS gross
    FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY 1
    """,
)
def i19(t):
    path = write_lines_by_month(t, "i19")
    return (
        t.spark.read.parquet(path)
        .where("ship_year = 1997")
        .groupBy("ship_month")
        .agg(F.count("*").alias("line_count"), numbers.total("l_extendedprice").alias("gross"))
    )


@query(
    "i19_pruned_by_join",
    f"""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS ship_month, COUNT(*) AS line_count, {sql_total('l_extendedprice')} AS gross
    FROM lineitem SEMI JOIN (
      SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, COUNT(*) AS n, MAX(COUNT(*)) OVER () AS most FROM orders GROUP BY 1, 2) ON n = most AND year(l_shipdate) = y AND month(l_shipdate) = m
    GROUP BY 1, 2
    """,
)
def i19_by_join(t):
    """Lines shipped in the months with the most orders: which folders are read is found out by the join itself."""
    months = t.orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count("*").alias("n"))
    busiest = months.where(F.col("n") >= months.agg(F.max("n")).scalar())
    lines = t.spark.read.parquet(write_lines_by_month(t, "i19join"))
    return pruned_by(lines, busiest, {"ship_year": "y", "ship_month": "m"}).groupBy("ship_year", "ship_month").agg(
        F.count("*").alias("line_count"), numbers.total("l_extendedprice").alias("gross")
    )


@query(
    "i20_layout",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS ship_month, COUNT(*) AS row_count, TRUE AS has_files, TRUE AS has_bytes
    FROM lineitem GROUP BY ALL
    """,
)
def i20(t):
    path = write_lines_by_month(t, "i20")
    layout = sinks.partition_layout(t.spark.read.parquet(path), ["ship_year", "ship_month"])
    return layout.select("ship_year", "ship_month", "row_count", (F.col("file_count") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "i20_layout_rows",
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, COUNT(*) AS row_count, TRUE AS has_bytes FROM lineitem GROUP BY 1",
)
def i20_rows(t):
    path = write_lines_by_month(t, "i20")
    layout = sinks.partition_layout(t.spark.read.parquet(path), ["ship_year"])
    return layout.select("ship_year", "row_count", (F.col("bytes") > 0).alias("has_bytes"))
