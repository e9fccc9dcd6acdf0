"""Projections, filters, predicates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.catalog.registry import SQL_REVENUE, query, sql_mean, sql_round, sql_total
from strataloom.functions import numbers, text
from strataloom.operators import aggregates as agg


@query("p01_project", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total_price FROM orders")
def p01(t):
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("total_price")
    )


@query(
    "p02_line_amount",
    "SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS DOUBLE) AS line_amount, l_extendedprice / l_quantity AS unit_price FROM lineitem",
)
def p02(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        numbers.tidy(numbers.net_price("l_extendedprice", "l_discount"), 4).alias("line_amount"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


@query("p03_round_col", f"SELECT o_orderkey, {sql_round('o_totalprice', 0)} AS o_totalprice FROM orders")
def p03(t):
    return t.orders.select("o_orderkey", "o_totalprice").withColumn("o_totalprice", numbers.round_half_up("o_totalprice", 0))


def quantity_band(col="l_quantity"):
    q = F.col(col)
    return F.when(q < 10, "small").when(q < 30, "medium").when(q <= 45, "large").otherwise("bulk")


SQL_BAND = "CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' WHEN l_quantity <= 45 THEN 'large' ELSE 'bulk' END"


@query("p04_case_band", f"SELECT {SQL_BAND} AS band, COUNT(*) AS line_count FROM lineitem GROUP BY 1")
def p04(t):
    return t.lineitem.groupBy(quantity_band().alias("band")).agg(F.count("*").alias("line_count"))


@query(
    "p05_case_map",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status_name,
           CASE isodow(o_orderdate) WHEN 6 THEN 'weekend' WHEN 7 THEN 'weekend' ELSE 'workday' END AS day_kind
    FROM orders
    """,
)
def p05(t):
    status = F.col("o_orderstatus")
    weekday = F.weekday("o_orderdate") + 1
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "finished").when(status == "O", "open").otherwise("other").alias("status_name"),
        F.when(weekday.isin(6, 7), "weekend").otherwise("workday").alias("day_kind"),
    )


@query(
    "p06_valid_rows",
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_quantity > 0 AND l_extendedprice > 0 AND l_shipdate > o_orderdate
    """,
)
def p06(t):
    lines = t.lineitem.where((F.col("l_quantity") > 0) & (F.col("l_extendedprice") > 0))
    dates = t.orders.select("o_orderkey", "o_orderdate")
    return lines.join(dates, F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate > o_orderdate").select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "p07_between",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'",
)
def p07(t):
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1996-12-31"))
    return t.orders.where(F.col("o_orderdate").between(lo, hi)).select("o_orderkey", "o_orderdate")


@query(
    "p08_price_tolerance",
    """
    SELECT p_partkey, p_retailprice FROM part
    WHERE p_retailprice IS NULL OR p_size IS NULL OR NULLIF(p_size, 7) IS NULL
       OR p_retailprice NOT BETWEEN 910 + NULLIF(p_size, 7) AND 990 - NULLIF(p_size, 7)
    """,
)
def p08(t):
    size = F.nullif(F.col("p_size"), F.lit(7))
    price = F.col("p_retailprice")
    inside = price.between(910 + size, 990 - size)
    return t.part.where(~inside | price.isNull() | size.isNull()).select("p_partkey", "p_retailprice")


@query("p09_in_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def p09(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("p10_not_like", "SELECT doc_id, lang FROM documents WHERE text NOT LIKE '%@%'")
def p10(t):
    return t.documents.where(~F.col("text").like("%@%")).select("doc_id", "lang")


@query(
    "p10_like",
    "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring' AND p_brand LIKE 'Brand#1_'",
)
def p10_like(t):
    return t.part.where(F.col("p_name").like("%ring") & F.col("p_brand").like("Brand#1_")).select("p_partkey", "p_name")


@query(
    "p11_not_null",
    "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL",
)
def p11(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").where(F.col("quality").isNotNull()).select("doc_id", "quality")


@query(
    "p12_casts",
    """
    SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_shipdate AS DATE) AS ship_date,
           CAST(l_linenumber AS VARCHAR) AS line_text, CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
           TRY_CAST(l_returnflag AS INTEGER) AS flag_number
    FROM lineitem
    """,
)
def p12(t):
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("double").alias("price"),
        F.col("l_returnflag").try_cast("int").alias("flag_number"),
    )


SQL_DIRTY_FLAG = "CASE WHEN l_linestatus = 'F' THEN '  ' WHEN l_linestatus = 'O' THEN ' ' || l_returnflag || ' ' END"


def dirty_flag():
    return F.when(F.col("l_linestatus") == "F", "  ").when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" ")))


@query(
    "p13_blank_to_null",
    f"SELECT NULLIF(TRIM({SQL_DIRTY_FLAG}), '') AS flag, COUNT(*) AS line_count FROM lineitem GROUP BY 1",
)
def p13(t):
    return t.lineitem.groupBy(text.blank_to_null(dirty_flag()).alias("flag")).agg(F.count("*").alias("line_count"))


@query(
    "p14_coalesce",
    """
    SELECT d.doc_id, COALESCE(quality, -1) AS quality, COALESCE(CAST(toxic AS VARCHAR), 'unknown') AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def p14(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        "doc_id",
        F.coalesce("quality", F.lit(-1)).alias("quality"),
        F.coalesce(F.col("toxic").cast("string"), F.lit("unknown")).alias("toxic"),
    )


@query("p15_distinct", "SELECT DISTINCT p_type, p_brand FROM part")
def p15(t):
    return t.part.select("p_type", "p_brand").distinct()


@query("p16_flag", "SELECT c_custkey, c_acctbal < 0 AS in_debt, c_mktsegment = 'BUILDING' AS is_building FROM customer")
def p16(t):
    return t.customer.select(
        "c_custkey", (F.col("c_acctbal") < 0).alias("in_debt"), (F.col("c_mktsegment") == "BUILDING").alias("is_building")
    )


@query("p17_view", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 5000")
def p17(t):
    t.customer.where("c_acctbal > 5000").createOrReplaceTempView("rich_customers")
    return t.spark.sql("SELECT c_custkey, c_name, c_acctbal FROM rich_customers")


# Sorts and top-k -----------------------------------------------------------


@query("t01_multi_sort", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def t01(t):
    return t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


SQL_PART_REVENUE = f"""
    SELECT p_partkey, p_name, p_brand, {sql_total('l_quantity')} AS quantity, {SQL_REVENUE} AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
"""


def part_revenue(t):
    """Lines are summed per part key before the join, so part meets one row per key."""
    sums = t.lineitem.groupBy("l_partkey").agg(
        numbers.total("l_quantity").alias("quantity"), numbers.total(numbers.net_price("l_extendedprice", "l_discount"), 4).alias("revenue")
    )
    return sums.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "p_name", "p_brand", "p_type", "quantity", "revenue")


@query("t02_top10", f"SELECT * FROM ({SQL_PART_REVENUE}) ORDER BY revenue DESC, p_partkey LIMIT 10")
def t02(t):
    return agg.top_k(part_revenue(t).drop("p_type"), [F.desc("revenue"), F.asc("p_partkey")], 10)


@query(
    "t03_nulls_last",
    """
    SELECT c_custkey, NULLIF(c_mktsegment, 'AUTOMOBILE') AS segment FROM customer
    ORDER BY segment DESC NULLS LAST, c_custkey LIMIT 50
    """,
)
def t03(t):
    rows = t.customer.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("AUTOMOBILE")).alias("segment"))
    return agg.top_k(rows, [F.col("segment").desc_nulls_last(), F.col("c_custkey").asc()], 50)


@query(
    "t04_rank20",
    """
    SELECT c_custkey, c_acctbal, ROW_NUMBER() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank
    FROM customer QUALIFY rank <= 20
    """,
)
def t04(t):
    return agg.top_k_ranked(t.customer.select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_custkey")], 20)


@query(
    "t05_top5_days",
    f"""
    SELECT CAST(o_orderdate AS DATE) AS order_date, {sql_mean('o_totalprice')} AS avg_price FROM orders
    GROUP BY 1 ORDER BY avg_price DESC, order_date LIMIT 5
    """,
)
def t05(t):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(numbers.mean("o_totalprice").alias("avg_price"))
    return agg.top_k(days, [F.desc("avg_price"), F.asc("order_date")], 5)


# Set operations ------------------------------------------------------------

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


@query("u01_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in ALL_TABLES))
def u01(t):
    return agg.row_counts({n: getattr(t, n) for n in ALL_TABLES})


@query(
    "u02_union_violations",
    """
    SELECT o_orderkey, 'status_unknown' AS rule_name FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'price_low' FROM orders WHERE o_totalprice < 50000
    UNION ALL SELECT o_orderkey, 'priority_unset' FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
    """,
)
def u02(t):
    from strataloom.plans.quality import Rule, apply_rules, violations

    rules = [
        Rule("status_unknown", F.col("o_orderstatus") == "P", "status", F.col("o_orderstatus")),
        Rule("price_low", F.col("o_totalprice") < 50000, "price", F.col("o_totalprice").cast("string")),
        Rule("priority_unset", F.col("o_orderpriority") == "4-NOT SPECIFIED", "priority", F.col("o_orderpriority")),
    ]
    return violations(apply_rules(t.orders, rules), rules, ["o_orderkey"]).select("o_orderkey", "rule_name")


SQL_KEYS_A = "SELECT DISTINCT c_custkey AS key_value FROM customer WHERE c_acctbal > 0"
SQL_KEYS_B = "SELECT DISTINCT o_custkey AS key_value FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"


def _key_sets(t):
    a = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("key_value")).distinct()
    b = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return agg.key_sets(a, b.select(F.col("o_custkey").alias("key_value")).distinct())


@query("u03_intersect", f"{SQL_KEYS_A} INTERSECT {SQL_KEYS_B}")
def u03_both(t):
    return _key_sets(t)["both"]


@query("u03_left_only", f"{SQL_KEYS_A} EXCEPT {SQL_KEYS_B}")
def u03_left(t):
    return _key_sets(t)["left_only"]


@query("u03_right_only", f"{SQL_KEYS_B} EXCEPT {SQL_KEYS_A}")
def u03_right(t):
    return _key_sets(t)["right_only"]


@query(
    "u04_concat",
    """
    SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, 'supplier' FROM supplier
    """,
)
def u04(t):
    a = t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"), F.col("c_nationkey").alias("nation_key"), F.lit("customer").alias("kind"))
    b = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation_key"), F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name"))
    return agg.union_all([a, b])
