"""Window functions, in forms that hold when one key has very many rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.catalog.projection import part_revenue
from strataloom.catalog.registry import query, sql_round
from strataloom.functions import dates, numbers
from strataloom.operators import windows as win
from strataloom.operators.aggregates import first_and_last
from strataloom.operators.joins import star_join

SQL_DAY_REGION = f"""
    SELECT CAST(o_orderdate AS DATE) AS order_date, r_name, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS day_sales
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
"""


def day_region_sales(t):
    wide = star_join(
        t.orders, (t.customer, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")
    )
    return wide.groupBy(F.to_date("o_orderdate").alias("order_date"), "r_name").agg(numbers.exact_sum("o_totalprice").alias("day_sales"))


@query(
    "w01_running_sum",
    f"""
    SELECT order_date, r_name, CAST(day_sales AS DOUBLE) AS day_sales,
           CAST(SUM(day_sales) OVER (PARTITION BY r_name ORDER BY order_date) AS DOUBLE) AS running_sales
    FROM ({SQL_DAY_REGION})
    """,
)
def w01(t):
    summed = win.running_sum_by_date(day_region_sales(t), ["r_name"], "order_date", "day_sales", "running_sales")
    return summed.select("order_date", "r_name", F.col("day_sales").cast("double").alias("day_sales"), F.col("running_sales").cast("double").alias("running_sales"))


@query(
    "w01_running_sum_events",
    f"""
    SELECT event_id, user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts) AS DOUBLE) AS running_value
    FROM events
    """,
)
def w01_events(t):
    rows = t.events.select("event_id", "user_id", "ts", numbers.money("value").alias("amount"))
    summed = win.running_sum_in_group(rows, ["user_id"], "ts", "amount", "running_value")
    return summed.select("event_id", "user_id", F.col("running_value").cast("double").alias("running_value"))


SQL_TYPE_REVENUE = f"""
    SELECT p_type, p_partkey, CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
"""


@query(
    "w02_rank_in_group",
    f"SELECT p_type, p_partkey, revenue, RANK() OVER (PARTITION BY p_type ORDER BY revenue DESC) AS rank_in_type FROM ({SQL_TYPE_REVENUE})",
)
def w02(t):
    revenue = part_revenue(t).select("p_type", "p_partkey", "revenue")
    return win.rank_in_group(revenue, ["p_type"], "revenue", "rank_in_type")


@query(
    "w03_top3_per_day",
    """
    SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderkey, o_totalprice,
           ROW_NUMBER() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_totalprice DESC, o_orderkey) AS rank
    FROM orders QUALIFY rank <= 3
    """,
)
def w03(t):
    rows = t.orders.select(F.to_date("o_orderdate").alias("order_date"), "o_orderkey", "o_totalprice")
    return win.top_n_per_group(rows, ["order_date"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, rank_as="rank")


@query(
    "w04_latest",
    "SELECT user_id, event_id, ts, event_type FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def w04(t):
    return win.first_per_key(t.events.select("user_id", "event_id", "ts", "event_type"), ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(
    "w05_lag_delta",
    f"""
    SELECT event_id, value, previous, {sql_round('value - previous', 2)} AS delta FROM (
      SELECT event_id, value, LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    """,
)
def w05(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    lagged = win.lag_in_group(rows, ["user_id"], ["ts", "event_id"], "value", "previous")
    return lagged.select("event_id", "value", "previous", numbers.round_half_up(F.col("value") - F.col("previous"), 2).alias("delta"))


@query(
    "w06_lead",
    "SELECT event_id, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events",
)
def w06(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return win.lead_in_group(rows, ["user_id"], ["ts", "event_id"], "ts", "next_ts").select("event_id", "next_ts")


@query(
    "w07_row_number_sku",
    """
    SELECT p_partkey, p_name, 'SKU-' || lpad(CAST(ROW_NUMBER() OVER (ORDER BY p_name, p_partkey) AS VARCHAR), 12, '0') AS sku FROM part
    """,
)
def w07(t):
    numbered = win.global_row_number(t.part.select("p_partkey", "p_name"), ["p_name", "p_partkey"], "n")
    return numbered.select("p_partkey", "p_name", F.concat(F.lit("SKU-"), F.lpad(F.col("n").cast("string"), 12, "0")).alias("sku"))


@query(
    "w08_distinct_on",
    """
    SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    """,
)
def w08(t):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return win.first_per_key(t.lineitem.select(*columns), ["l_orderkey"], columns[1:])


@query(
    "w09_first_last",
    """
    SELECT CAST(ts AS DATE) AS day, FIRST(event_id ORDER BY ts, event_id) AS first_event, LAST(event_id ORDER BY ts, event_id) AS last_event
    FROM events GROUP BY 1
    """,
)
def w09(t):
    rows = t.events.select(F.to_date("ts").alias("day"), "ts", "event_id")
    return first_and_last(rows, ["day"], ["ts", "event_id"], "event_id", "first_event", "last_event")


@query(
    "w10_dense_rank",
    f"""
    SELECT event_type, event_id, DENSE_RANK() OVER (PARTITION BY event_type ORDER BY value DESC) AS value_rank FROM events
    """,
)
def w10(t):
    rows = t.events.select("event_type", "event_id", "value")
    return win.rank_in_group(rows, ["event_type"], "value", "value_rank", dense=True).drop("value")


@query(
    "w11_seconds_to_next",
    """
    SELECT event_id, CAST(epoch(date_trunc('second', LEAD(ts) OVER w)) - epoch(date_trunc('second', ts)) AS BIGINT) AS seconds_to_next
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def w11(t):
    rows = t.events.select("event_id", "user_id", "ts")
    ahead = win.lead_in_group(rows, ["user_id"], ["ts", "event_id"], "ts", "next_ts")
    return ahead.select("event_id", dates.seconds_between("ts", "next_ts").alias("seconds_to_next"))
