"""Aggregations over single tables and over the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.catalog.projection import SQL_BAND, quantity_band
from strataloom.catalog.registry import SQL_REVENUE, query, sql_mean, sql_round, sql_total
from strataloom.functions import numbers
from strataloom.operators import aggregates as agg
from strataloom.operators import bitmaps
from strataloom.operators.joins import star_join
from strataloom.session import new_dir
from strataloom.sources import sinks

def net():
    return numbers.net_price("l_extendedprice", "l_discount")


@query("g01_count", "SELECT COUNT(*) AS n FROM lineitem")
def g01(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("g02_group_count", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY ALL")
def g02(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


def daily_store_sales(t):
    """Revenue per order date and nation.

    Lines are summed per order before the order join, which cuts the rows that
    cross the shuffle and needs the shuffle on the order key only once.
    """
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), numbers.exact_sum("l_quantity").alias("qty"), numbers.exact_sum(net(), 4).alias("net")
    )
    wide = star_join(
        per_order, (t.orders, "l_orderkey", "o_orderkey"), (t.customer, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey")
    )
    return wide.groupBy(F.to_date("o_orderdate").alias("order_date"), "n_name").agg(
        F.sum("lines").alias("sale_count"), F.sum("qty").cast("double").alias("quantity"), F.sum("net").cast("double").alias("revenue")
    )


@query(
    "g03_daily_store_sales",
    f"""
    SELECT CAST(o_orderdate AS DATE) AS order_date, n_name, COUNT(*) AS sale_count, {sql_total('l_quantity')} AS quantity, {SQL_REVENUE} AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
    """,
)
def g03(t):
    return daily_store_sales(t)


@query(
    "g04_category_avg",
    f"""
    SELECT p_type, COUNT(*) AS sale_count, {sql_total('l_quantity')} AS quantity, {SQL_REVENUE} AS revenue,
           {sql_mean('l_extendedprice')} AS avg_price
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
    """,
)
def g04(t):
    """Lines are summed per part first; part meets one row per key."""
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("n"),
        numbers.exact_sum("l_quantity").alias("quantity"),
        numbers.exact_sum(net(), 4).alias("revenue"),
        numbers.exact_sum("l_extendedprice").alias("price"),
    )
    typed = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type")
    return typed.agg(
        F.sum("n").alias("sale_count"),
        F.sum("quantity").cast("double").alias("quantity"),
        F.sum("revenue").cast("double").alias("revenue"),
        numbers.mean_of_sums("price", "n").alias("avg_price"),
    )


@query("g05_count_distinct", "SELECT COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def g05(t):
    return t.lineitem.agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query(
    "g05_distinct_rollup",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(quarter(l_shipdate) AS INTEGER) AS ship_quarter, COUNT(DISTINCT l_partkey) AS parts
    FROM lineitem GROUP BY ALL
    UNION ALL SELECT CAST(year(l_shipdate) AS INTEGER), NULL, COUNT(DISTINCT l_partkey) FROM lineitem GROUP BY ALL
    """,
)
def g05_rollup(t):
    """Bitmaps of parts are stored per ship month; quarters and years are counted from them alone."""
    monthly = bitmaps.id_bitmaps(t.lineitem.withColumn("month", F.trunc("l_shipdate", "MM")), ["month"], "l_partkey")
    stored = sinks.full_refresh(monthly, new_dir(t.spark, "g05bits"))
    dated = stored.select(F.year("month").alias("ship_year"), F.quarter("month").alias("ship_quarter"), *bitmaps.STORED)
    quarters = bitmaps.united(dated, ["ship_year", "ship_quarter"])
    years = bitmaps.distinct_count(quarters, ["ship_year"], "parts").withColumn("ship_quarter", F.lit(None).cast("int"))
    return bitmaps.distinct_count(quarters, ["ship_year", "ship_quarter"], "parts").unionByName(years)


@query(
    "g05_trailing_users",
    """
    WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM events)
    SELECT a.day, COUNT(DISTINCT b.user_id) AS users FROM (SELECT DISTINCT day FROM d) a JOIN d b ON b.day BETWEEN a.day - 6 AND a.day GROUP BY 1
    """,
)
def g05_trailing(t):
    """Different users of the seven days up to each day, from one bitmap a day."""
    daily = bitmaps.id_bitmaps(t.events.withColumn("day", F.to_date("ts")), ["day"], "user_id")
    return bitmaps.trailing_distinct(sinks.full_refresh(daily, new_dir(t.spark, "g05days")), "day", 7, "users")


@query(
    "g06_segment",
    f"""
    SELECT c_mktsegment, COUNT(DISTINCT c_custkey) AS customers, COUNT(*) AS orders, {sql_total('o_totalprice')} AS sales,
           {sql_mean('o_totalprice')} AS avg_order,
           {sql_round("CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(DISTINCT c_custkey)", 2)} AS sales_per_customer
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
    """,
)
def g06(t):
    """Orders are reduced to one row per customer first; then a plain count replaces COUNT(DISTINCT)."""
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), numbers.exact_sum("o_totalprice").alias("sales"))
    joined = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    grouped = joined.groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("sales").alias("sales_exact")
    )
    sales = F.col("sales_exact").cast("double")
    return grouped.select(
        "c_mktsegment",
        "customers",
        "orders",
        sales.alias("sales"),
        F.round(F.col("sales_exact").cast("decimal(30,6)") / F.col("orders"), 2).cast("double").alias("avg_order"),
        numbers.round_half_up(sales / F.col("customers"), 2).alias("sales_per_customer"),
    )


@query(
    "g07_share",
    f"""
    SELECT o_orderpriority, sales, {sql_round('100.0::DOUBLE * sales / (SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders)', 1)} AS share_pct
    FROM (SELECT o_orderpriority, {sql_total('o_totalprice')} AS sales FROM orders GROUP BY 1)
    """,
)
def g07(t):
    groups = t.orders.groupBy("o_orderpriority").agg(numbers.exact_sum("o_totalprice").alias("sales"))
    return agg.share_of_total(groups, "sales").withColumn("sales", F.col("sales").cast("double"))


@query("g08_having_dups", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def g08(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("g09_min_max_ts", "SELECT user_id, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events GROUP BY 1")
def g09(t):
    return t.events.groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query(
    "g10_string_agg",
    "SELECT o_custkey, STRING_AGG(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
)
def g10(t):
    return agg.distinct_list(t.orders, ["o_custkey"], "o_orderpriority", "priorities")


@query(
    "g11_conditional_sum",
    """
    SELECT COUNT(*) AS row_count, COUNT(*) FILTER (o_totalprice <= 1000) AS low_price,
           CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS pending,
           COUNT(*) FILTER (o_orderdate < TIMESTAMP '1996-01-01') AS early
    FROM orders
    """,
)
def g11(t):
    return t.orders.agg(
        F.count("*").alias("row_count"),
        agg.count_where(F.col("o_totalprice") <= 1000).alias("low_price"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("pending"),
        agg.count_where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("early"),
    )


@query(
    "g12_left_agg",
    """
    SELECT c_custkey, COUNT(o_orderkey) AS order_count, CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS sales
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') ON c_custkey = o_custkey
    GROUP BY 1
    """,
)
def g12(t):
    """The fact is summed per customer before the outer join, so a customer with many orders is one row there."""
    orders = t.orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    sums = orders.groupBy("o_custkey").agg(F.count("*").alias("n"), numbers.exact_sum("o_totalprice").alias("s"))
    return t.customer.join(sums, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).cast("bigint").alias("order_count"), F.coalesce(F.col("s").cast("double"), F.lit(0.0)).alias("sales")
    )


@query(
    "g13_group_bool",
    f"SELECT isodow(o_orderdate) >= 6 AS is_weekend, COUNT(*) AS order_count, {sql_total('o_totalprice')} AS sales FROM orders GROUP BY 1",
)
def g13(t):
    return t.orders.groupBy((F.weekday("o_orderdate") >= 5).alias("is_weekend")).agg(
        F.count("*").alias("order_count"), numbers.total("o_totalprice").alias("sales")
    )


@query(
    "g14_band_summary",
    f"""
    SELECT {SQL_BAND} AS band, CAST(quarter(l_shipdate) AS BIGINT) AS quarter, COUNT(*) AS line_count,
           {sql_mean('l_extendedprice')} AS avg_price, {sql_mean('l_quantity')} AS avg_quantity
    FROM lineitem GROUP BY ALL
    """,
)
def g14(t):
    return t.lineitem.groupBy(quantity_band().alias("band"), F.quarter("l_shipdate").cast("bigint").alias("quarter")).agg(
        F.count("*").alias("line_count"), numbers.mean("l_extendedprice").alias("avg_price"), numbers.mean("l_quantity").alias("avg_quantity")
    )


SQL_DAILY = f"""
    SELECT CAST(ts AS DATE) AS day, COUNT(*) AS event_count, {sql_total('value')} AS total_value, {sql_mean('value')} AS avg_value
    FROM events GROUP BY 1
"""


@query("g15_daily_df", SQL_DAILY)
def g15_df(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("event_count"), numbers.total("value").alias("total_value"), numbers.mean("value").alias("avg_value")
    )


@query("g15_daily_sql", SQL_DAILY)
def g15_sql(t):
    return t.spark.sql(
        """
        SELECT to_date(ts) AS day, count(*) AS event_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
               CAST(round(avg(CAST(value AS DECIMAL(18,2))), 2) AS DOUBLE) AS avg_value
        FROM {events} GROUP BY to_date(ts)
        """,
        events=t.events,
    )


@query(
    "g16_overview",
    """
    SELECT (SELECT COUNT(*) FROM orders) AS orders, (SELECT COUNT(DISTINCT o_custkey) FROM orders) AS buyers,
           (SELECT COUNT(*) FROM customer) AS customers, (SELECT COUNT(*) FROM lineitem) AS lines
    """,
)
def g16(t):
    count = F.count("*")
    return agg.scalars(
        t.spark,
        orders=t.orders.agg(count),
        buyers=t.orders.agg(F.count_distinct("o_custkey")),
        customers=t.customer.agg(count),
        lines=t.lineitem.agg(count),
    )


def _sql_describe(table, column):
    return f"""
    SELECT '{column}' AS column_name, COUNT({column}) AS n, ROUND(AVG({column}), 2) AS mean, ROUND(STDDEV_SAMP({column}), 2) AS stddev,
           CAST(MIN({column}) AS DOUBLE) AS min, CAST(MAX({column}) AS DOUBLE) AS max FROM {table}
    """


@query("g17_describe", " UNION ALL ".join(_sql_describe("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def g17(t):
    return agg.describe_columns(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], places=2)


@query(
    "g18_text_len",
    f"""
    SELECT source, lang, COUNT(*) AS doc_count, {sql_round('AVG(length(text))', 0)} AS avg_length, CAST(SUM(length(text)) AS BIGINT) AS total_chars
    FROM documents GROUP BY ALL
    """,
)
def g18(t):
    n = F.length("text").cast("bigint")
    return t.documents.groupBy("source", "lang").agg(
        F.count("*").alias("doc_count"), numbers.round_half_up(F.avg(n), 0).alias("avg_length"), F.sum(n).alias("total_chars")
    )


@query(
    "g19_order_total",
    f"SELECT l_orderkey, COUNT(*) AS line_count, {SQL_REVENUE} AS order_total FROM lineitem GROUP BY 1",
)
def g19(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("line_count"), numbers.total(net(), 4).alias("order_total"))
