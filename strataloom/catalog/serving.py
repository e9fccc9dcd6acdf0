"""Named metrics for reports: definition, slice and drill-down."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.catalog.registry import SQL_NET, query, sql_round
from strataloom.functions import numbers
from strataloom.operators.joins import star_join
from strataloom.plans.metrics import Metric, Ratio, drill_down, measure


def sales_facts(t):
    """One row per order: lines are summed before they meet the dimensions."""
    net = numbers.net_price("l_extendedprice", "l_discount")
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        numbers.exact_sum(net, 4).alias("net"), numbers.exact_sum(F.when(F.col("l_returnflag") == "R", net), 4).alias("returned")
    )
    return star_join(
        per_order,
        (t.orders, "l_orderkey", "o_orderkey"),
        (t.customer, "o_custkey", "c_custkey"),
        (t.nation, "c_nationkey", "n_nationkey"),
        (t.region, "n_regionkey", "r_regionkey"),
    )


NET_REVENUE = Metric("net_revenue", F.sum, "net", result="double")
ORDER_COUNT = Metric("order_count", F.count, "o_orderkey")
RETURNED = Metric("returned_value", F.sum, "returned", result="double")
URGENT_ORDERS = Metric("urgent_orders", F.count, "o_orderkey", where="o_orderpriority = '1-URGENT'")
AVG_ORDER = Ratio("avg_order_value", NET_REVENUE, ORDER_COUNT)

SQL_FACTS = f"""
    (SELECT o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, c_custkey, c_mktsegment, n_name, r_name, net FROM
      (SELECT l_orderkey, SUM({SQL_NET}) AS net FROM lineitem GROUP BY 1) JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
SQL_METRICS = f"""
    CAST(SUM(net) AS DOUBLE) AS net_revenue, COUNT(*) AS order_count, {sql_round('CAST(SUM(net) AS DOUBLE) / COUNT(*)', 2)} AS avg_order_value
"""


@query(
    "b01_metric",
    f"SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, {SQL_METRICS}, COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS urgent_orders FROM {SQL_FACTS} GROUP BY 1",
)
def b01(t):
    facts = sales_facts(t).withColumn("order_year", F.year("o_orderdate").cast("bigint"))
    return measure(facts, [NET_REVENUE, ORDER_COUNT, AVG_ORDER, URGENT_ORDERS], ["order_year"])


@query(
    "b02_slice",
    f"SELECT c_mktsegment, o_orderpriority, {SQL_METRICS} FROM {SQL_FACTS} WHERE r_name IN ('ASIA', 'EUROPE') AND o_orderstatus = 'F' GROUP BY ALL",
)
def b02(t):
    filters = [F.col("r_name").isin("ASIA", "EUROPE"), F.col("o_orderstatus") == "F"]
    return measure(sales_facts(t), [NET_REVENUE, ORDER_COUNT, AVG_ORDER], ["c_mktsegment", "o_orderpriority"], filters)


@query(
    "b03_drill",
    f"""
    SELECT r_name, n_name, c_custkey, CAST(3 - GROUPING(r_name) - GROUPING(n_name) - GROUPING(c_custkey) AS BIGINT) AS level_no, {SQL_METRICS}
    FROM {SQL_FACTS} GROUP BY ROLLUP (r_name, n_name, c_custkey)
    """,
)
def b03(t):
    return drill_down(sales_facts(t), [NET_REVENUE, ORDER_COUNT, AVG_ORDER], ["r_name", "n_name", "c_custkey"])
