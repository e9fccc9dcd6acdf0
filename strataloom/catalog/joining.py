"""Joins, from one dimension to the whole star, and key checks."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F

from strataloom.catalog.registry import SQL_NET, SQL_REVENUE, query, sql_total
from strataloom.functions import numbers, text
from strataloom.operators import joins
from strataloom.plans.scd import scd2_from_snapshots
from strataloom.session import new_dir
from strataloom.sources import sinks

def revenue():
    return numbers.net_price("l_extendedprice", "l_discount")


@query(
    "j01_inner",
    f"SELECT p_type, COUNT(*) AS line_count, {sql_total('l_extendedprice')} AS gross FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
)
def j01(t):
    """Lines are summed per part first; part meets one row per key."""
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"), numbers.exact_sum("l_extendedprice").alias("sum"))
    typed = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type")
    return typed.agg(F.sum("n").alias("line_count"), F.sum("sum").cast("double").alias("gross"))


@query(
    "j02_star_join",
    f"""
    SELECT l_orderkey, l_linenumber, o_orderpriority, p_name, s_name, c_name, n_name,
           CAST({SQL_NET} AS DOUBLE) AS net
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    """,
)
def j02(t):
    wide = joins.star_join(
        t.lineitem,
        (t.orders, "l_orderkey", "o_orderkey"),
        (t.part, "l_partkey", "p_partkey"),
        (t.supplier, "l_suppkey", "s_suppkey"),
        (t.customer, "o_custkey", "c_custkey"),
        (t.nation, "c_nationkey", "n_nationkey"),
    )
    return wide.select("l_orderkey", "l_linenumber", "o_orderpriority", "p_name", "s_name", "c_name", "n_name", numbers.tidy(revenue(), 4).alias("net"))


@query(
    "j03_composite",
    """
    WITH first_sale AS (SELECT l_partkey, l_suppkey, l_returnflag, MIN(l_shipdate) AS first_ship FROM lineitem GROUP BY ALL)
    SELECT l.l_orderkey, l.l_linenumber, CAST(date_diff('day', f.first_ship, l.l_shipdate) AS BIGINT) AS days_since_first
    FROM lineitem l JOIN first_sale f
      ON l.l_partkey = f.l_partkey AND l.l_suppkey = f.l_suppkey AND l.l_returnflag = f.l_returnflag
    """,
)
def j03(t):
    keys = ["l_partkey", "l_suppkey", "l_returnflag"]
    first = t.lineitem.groupBy(*keys).agg(F.min("l_shipdate").alias("first_ship"))
    return t.lineitem.join(first, keys).select(
        "l_orderkey", "l_linenumber", F.datediff("l_shipdate", "first_ship").cast("bigint").alias("days_since_first")
    )


@query(
    "j04_left",
    """
    SELECT c_custkey, o_orderkey FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o ON c_custkey = o_custkey
    """,
)
def j04(t):
    return joins.left_join_many(t.customer, _urgent_finished(t), "c_custkey", "o_custkey").select("c_custkey", "o_orderkey")


def _urgent_finished(t):
    return t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))


@query(
    "j05_multi_left",
    """
    SELECT d.doc_id, d.lang, l.quality, c.turns, p.url
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    LEFT JOIN (SELECT conv_id, COUNT(*) AS turns FROM conversations GROUP BY 1) c ON d.doc_id = c.conv_id
    LEFT JOIN pages p ON d.doc_id = p.page_id
    """,
)
def j05(t):
    turns = t.conversations.groupBy("conv_id").agg(F.count("*").alias("turns"))
    return (
        t.documents.select("doc_id", "lang")
        .join(t.labels.select("doc_id", "quality"), "doc_id", "left")
        .join(turns, F.col("doc_id") == F.col("conv_id"), "left")
        .join(t.pages.select("page_id", "url"), F.col("doc_id") == F.col("page_id"), "left")
        .select("doc_id", "lang", "quality", "turns", "url")
    )


@query(
    "j06_normalized_key",
    """
    SELECT c_custkey, s_suppkey
    FROM (SELECT c_custkey, '  CUSTOMER#' || split_part(c_name, '#', 2) AS k FROM customer)
    LEFT JOIN (SELECT s_suppkey, 'customer#' || split_part(s_name, '#', 2) || ' ' AS k2 FROM supplier)
      ON LOWER(TRIM(k)) = LOWER(TRIM(k2))
    """,
)
def j06(t):
    number = lambda c: F.split_part(c, F.lit("#"), F.lit(2))
    left = t.customer.select("c_custkey", F.concat(F.lit("  CUSTOMER#"), number(F.col("c_name"))).alias("k"))
    right = t.supplier.select("s_suppkey", F.concat(F.lit("customer#"), number(F.col("s_name")), F.lit(" ")).alias("k2"))
    return left.join(right, text.normalized_key("k") == text.normalized_key("k2"), "left").select("c_custkey", "s_suppkey")


@query(
    "j07_left_anti",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
    """,
)
def j07(t):
    return joins.without_match(t.customer, _urgent_finished(t), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    "j08_not_exists",
    """
    SELECT o_orderkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    """,
)
def j08(t):
    """Each order with returns is one row before it is looked up."""
    returned = t.lineitem.where("l_returnflag = 'R'").select("l_orderkey").distinct()
    hit = returned.where(F.col("l_orderkey") == F.col("o_orderkey").outer())
    return t.orders.where(~hit.exists()).select("o_orderkey")


@query(
    "j09_orphans",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    LEFT JOIN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') ON l_partkey = p_partkey
    WHERE p_partkey IS NULL
    """,
)
def j09(t):
    return joins.orphans(t.lineitem, t.part.where("p_type <> 'PROMO'"), "l_partkey", "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


# Price list of each part: the highest price of a month, from lines with a discount below 5 %.
SQL_PRICE_SNAPSHOTS = """
    SELECT l_partkey AS part_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_month, MAX(l_extendedprice) AS price
    FROM lineitem WHERE l_discount < 0.05 GROUP BY ALL
"""
SQL_PRICE_VERSIONS = f"""
    SELECT part_id || ':' || CAST(snapshot_month AS VARCHAR) AS version_key, part_id, price, snapshot_month AS valid_from,
           COALESCE(CAST(LEAD(snapshot_month) OVER w - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
           LEAD(snapshot_month) OVER w IS NULL AS is_current
    FROM ({SQL_PRICE_SNAPSHOTS}) WINDOW w AS (PARTITION BY part_id ORDER BY snapshot_month)
"""


def price_versions(t):
    snapshots = (
        t.lineitem.where("l_discount < 0.05")
        .groupBy(F.col("l_partkey").alias("part_id"), F.trunc("l_shipdate", "MM").alias("snapshot_month"))
        .agg(F.max("l_extendedprice").alias("price"))
    )
    return scd2_from_snapshots(snapshots, "part_id", "snapshot_month", ["price"])


def _asof(t, how):
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_date"))
    return joins.asof_join(fact, price_versions(t), "l_partkey", "ship_date", "part_id", how=how).select(
        "l_orderkey", "l_linenumber", "ship_date", "version_key", "price"
    )


def _sql_asof(how):
    return f"""
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, version_key, price
    FROM lineitem {how} JOIN ({SQL_PRICE_VERSIONS}) ON l_partkey = part_id AND CAST(l_shipdate AS DATE) BETWEEN valid_from AND valid_to
    """


@query("j10_asof_inner", _sql_asof("INNER"))
def j10_inner(t):
    return _asof(t, "inner")


@query("j10_asof_left", _sql_asof("LEFT"))
def j10_left(t):
    return _asof(t, "left")


# Box sizes with the volume units they hold.
BOXES = [Row(box="small", units=6), Row(box="medium", units=20), Row(box="crate", units=75)]


@query(
    "j11_cross",
    """
    SELECT p_partkey, box, CAST(units // (1 + p_size) AS BIGINT) AS pieces, units % (1 + p_size) AS units_left
    FROM part CROSS JOIN (VALUES ('small', 6::BIGINT), ('medium', 20), ('crate', 75)) AS b(box, units)
    """,
)
def j11(t):
    boxed = joins.with_inline_rows(t.part.select("p_partkey", "p_size"), BOXES)
    need = (F.col("p_size") + 1).cast("bigint")
    return boxed.select("p_partkey", "box", F.floor(F.col("units") / need).alias("pieces"), (F.col("units") % need).alias("units_left"))


@query(
    "j12_lookup",
    """
    SELECT * FROM (SELECT
      (SELECT MIN(r_regionkey) FROM region WHERE r_name = 'ASIA') AS region_key,
      (SELECT MIN(s_suppkey) FROM supplier WHERE s_acctbal > 9000) AS supplier_key,
      (SELECT MIN(p_partkey) FROM part WHERE p_name = 'red widget') AS part_key,
      (SELECT MIN(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING') AS customer_key,
      (SELECT MIN(o_orderkey) FROM orders WHERE o_orderpriority = '2-HIGH') AS order_key)
    WHERE region_key IS NOT NULL AND supplier_key IS NOT NULL AND part_key IS NOT NULL AND customer_key IS NOT NULL AND order_key IS NOT NULL
    """,
)
def j12(t):
    return joins.lookup_row(
        t.spark,
        region_key=(t.region.where("r_name = 'ASIA'"), "r_regionkey"),
        supplier_key=(t.supplier.where("s_acctbal > 9000"), "s_suppkey"),
        part_key=(t.part.where("p_name = 'red widget'"), "p_partkey"),
        customer_key=(t.customer.where("c_mktsegment = 'BUILDING'"), "c_custkey"),
        order_key=(t.orders.where("o_orderpriority = '2-HIGH'"), "o_orderkey"),
    )


BUCKETS = 16


def bucketed_lines(t):
    """Lines and orders as tables with equal buckets of the order key."""
    location = new_dir(t.spark, "bucketed")
    layer = sinks.use_layer(t.spark, location.rsplit("/", 1)[1].replace("-", "_"), location)
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice", "l_discount")
    return (
        sinks.save_bucketed(lines, f"{layer}.lines", "l_orderkey", BUCKETS),
        sinks.save_bucketed(t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), f"{layer}.orders", "o_orderkey", BUCKETS),
    )


@query(
    "j13_bucketed",
    f"""
    SELECT o_orderkey, o_orderstatus, COUNT(*) AS line_count, COUNT(*) FILTER (l_shipdate < o_orderdate) AS early_lines, {SQL_REVENUE} AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def j13_bucketed(t):
    """Join and grouping on the key of the buckets: neither side is shuffled."""
    lines, orders = bucketed_lines(t)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey", "o_orderstatus").agg(
        F.count("*").alias("line_count"), F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("early_lines"), numbers.total(revenue(), 4).alias("revenue")
    )


@query(
    "j13_wide_join",
    f"""
    SELECT cr.r_name AS customer_region, sr.r_name AS supplier_region, p_type, CAST(year(o_orderdate) AS BIGINT) AS order_year,
           COUNT(*) AS line_count, {SQL_REVENUE} AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
    JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
    """,
)
def j13(t):
    def geography(prefix):
        return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias(f"{prefix}_nation"), F.col("r_name").alias(f"{prefix}_region")
        )

    wide = joins.star_join(
        t.lineitem,
        (t.part, "l_partkey", "p_partkey"),
        (t.supplier, "l_suppkey", "s_suppkey"),
        (geography("supplier"), "s_nationkey", "supplier_nation"),
        (t.orders, "l_orderkey", "o_orderkey"),
        (t.customer, "o_custkey", "c_custkey"),
        (geography("customer"), "c_nationkey", "customer_nation"),
    )
    return wide.groupBy("customer_region", "supplier_region", "p_type", F.year("o_orderdate").cast("bigint").alias("order_year")).agg(
        F.count("*").alias("line_count"), numbers.total(revenue(), 4).alias("revenue")
    )


@query(
    "j14_scalar_subquery",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT AVG(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders)",
)
def j14(t):
    average = t.orders.agg(F.avg(numbers.money("o_totalprice"))).scalar()
    return t.orders.where(F.col("o_totalprice") > average).select("o_orderkey", "o_totalprice")


@query(
    "j15_first_match",
    """
    SELECT o_orderkey, (SELECT MIN(s_suppkey) FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE c_custkey = o_custkey) AS local_supplier
    FROM orders
    """,
)
def j15(t):
    located = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_nationkey")
    return joins.first_match(located, t.supplier, "c_nationkey", "s_nationkey", "s_suppkey", "local_supplier").select("o_orderkey", "local_supplier")


@query(
    "j16_computed_key",
    """
    SELECT order_number, COUNT(*) AS line_count FROM (SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_number FROM orders)
    JOIN lineitem ON 'ORD-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') = order_number GROUP BY 1
    """,
)
def j16(t):
    number = lambda c: F.concat(F.lit("ORD-"), F.lpad(F.col(c).cast("string"), 12, "0"))
    headers = t.orders.select(number("o_orderkey").alias("order_number"))
    return t.lineitem.select(number("l_orderkey").alias("order_number")).join(headers, "order_number").groupBy("order_number").agg(F.count("*").alias("line_count"))


@query(
    "j17_reconcile",
    """
    WITH a AS (SELECT DISTINCT LOWER(TRIM(CAST(c_custkey AS VARCHAR))) AS k FROM customer WHERE c_acctbal > 0),
         b AS (SELECT DISTINCT LOWER(TRIM(CAST(o_custkey AS VARCHAR))) AS k FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
    SELECT COALESCE(a.k, b.k) AS key_value,
           CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' ELSE 'matched' END AS status
    FROM a FULL JOIN b ON a.k = b.k
    """,
)
def j17(t):
    return joins.reconcile_keys(t.customer.where("c_acctbal > 0"), _urgent_finished(t), "c_custkey", "o_custkey")


# Public holidays and weekday names.
HOLIDAYS = [
    Row(month=1, day=1, holiday="New Year"),
    Row(month=2, day=24, holiday="Independence Day"),
    Row(month=6, day=24, holiday="Midsummer"),
    Row(month=12, day=25, holiday="Christmas"),
]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


@query(
    "j18_holiday",
    """
    SELECT holiday, COUNT(*) AS order_count FROM orders
    LEFT JOIN (VALUES (1, 1, 'New Year'), (2, 24, 'Independence Day'), (6, 24, 'Midsummer'), (12, 25, 'Christmas')) AS h(month, day, holiday)
      ON month(o_orderdate) = h.month AND day(o_orderdate) = h.day
    GROUP BY 1
    """,
)
def j18(t):
    holidays = t.spark.createDataFrame(HOLIDAYS, "month int, day int, holiday string")
    dated = t.orders.select(F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"))
    # The calendar is a literal of a few rows, so the broadcast is bounded.
    return dated.join(F.broadcast(holidays), ["month", "day"], "left").groupBy("holiday").agg(F.count("*").alias("order_count"))


@query(
    "j18_weekday_name",
    "SELECT strftime(o_orderdate, '%A') AS weekday_name, COUNT(*) AS order_count FROM orders GROUP BY 1",
)
def j18_weekday(t):
    names = t.spark.createDataFrame(list(enumerate(WEEKDAYS)), "weekday int, weekday_name string")
    return (
        t.orders.select(F.weekday("o_orderdate").alias("weekday"))
        .join(F.broadcast(names), "weekday")
        .groupBy("weekday_name")
        .agg(F.count("*").alias("order_count"))
    )


@query("j19_match_count", "SELECT COUNT(*) AS match_count FROM lineitem JOIN events ON l_suppkey = user_id")
def j19(t):
    return joins.match_count(t.lineitem, t.events, "l_suppkey", "user_id")
