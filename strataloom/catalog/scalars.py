"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.catalog.registry import query, sql_round
from strataloom.functions import dates, numbers, text
from strataloom.operators.windows import lag_in_group
from strataloom.plans.dims import date_span


@query(
    "f01_case_trim",
    """
    SELECT p_partkey, UPPER(p_name) AS upper_name, LOWER(p_type) AS lower_type, TRIM('  ' || p_name || ' ') AS trimmed FROM part
    """,
)
def f01(t):
    return t.part.select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.trim(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("trimmed"),
    )


@query(
    "f02_initcap",
    r"""
    SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(LOWER(replace(p_name, ' ', '-') || ' O''' || p_type), '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'),
           lambda w: UPPER(w[1]) || w[2:]), '') AS display_name
    FROM part
    """,
)
def f02(t):
    raw = F.concat(F.translate("p_name", " ", "-"), F.lit(" O'"), F.col("p_type"))
    return t.part.select("p_partkey", text.capitalize_words(raw).alias("display_name"))


@query("f03_split_part", "SELECT c_custkey, split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number FROM customer")
def f03(t):
    part = lambda n: F.split_part("c_name", F.lit("#"), F.lit(n))
    return t.customer.select("c_custkey", part(1).alias("kind"), part(2).alias("number"))


@query(
    "f04_first_rest",
    """
    SELECT p_partkey, split_part(full_name, ' ', 1) AS first_name,
           CASE WHEN instr(full_name, ' ') > 0 THEN substr(full_name, instr(full_name, ' ') + 1) ELSE '' END AS last_name
    FROM (SELECT p_partkey, p_name || ' ' || p_type AS full_name FROM part UNION ALL SELECT s_suppkey, s_name FROM supplier)
    """,
)
def f04(t):
    names = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("full_name")).union(t.supplier.select("s_suppkey", "s_name"))
    return names.select("p_partkey", text.first_word("full_name").alias("first_name"), text.after_first_word("full_name").alias("last_name"))


@query(
    "f05_left_right",
    """
    SELECT s_suppkey, left(s_name, 4) AS head, right(s_name, 2) AS tail, repeat('*', 3) || left(s_name, 1) AS stars,
           CAST(greatest(length(s_name) - 10, 0) AS BIGINT) AS extra
    FROM supplier
    """,
)
def f05(t):
    return t.supplier.select(
        "s_suppkey",
        F.left("s_name", F.lit(4)).alias("head"),
        F.right("s_name", F.lit(2)).alias("tail"),
        F.concat(F.repeat(F.lit("*"), 3), F.left("s_name", F.lit(1))).alias("stars"),
        F.greatest(F.length("s_name") - 10, F.lit(0)).cast("bigint").alias("extra"),
    )


@query("f06_position", "SELECT doc_id, CAST(position('@' IN text) AS BIGINT) AS at_position FROM documents")
def f06(t):
    return t.documents.select("doc_id", F.position(F.lit("@"), F.col("text")).cast("bigint").alias("at_position"))


@query(
    "f07_concat",
    "SELECT c_custkey, c_name || ' / ' || NULLIF(c_mktsegment, 'BUILDING') AS label FROM customer",
)
def f07(t):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return t.customer.select("c_custkey", F.concat(F.col("c_name"), F.lit(" / "), segment).alias("label"))


@query("f08_lpad", "SELECT o_orderkey, 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_number FROM orders")
def f08(t):
    return t.orders.select("o_orderkey", F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("order_number"))


@query(
    "f09_md5_code",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
           THEN upper(substr(md5(CAST(o_orderkey AS VARCHAR) || o_orderpriority), 1, 8)) END AS auth_code
    FROM orders
    """,
)
def f09(t):
    code = text.short_code(F.concat(F.col("o_orderkey").cast("string"), F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), code).alias("auth_code"))


@query("f10_collapse_ws", r"SELECT doc_id, TRIM(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS text FROM documents")
def f10(t):
    return t.documents.select("doc_id", text.collapse_spaces("text").alias("text"))


@query("f11_safe_ident", "SELECT c_custkey, LOWER(regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g')) AS ident FROM customer")
def f11(t):
    return t.customer.select("c_custkey", text.safe_identifier("c_name").alias("ident"))


@query("f12_length", "SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS text_length FROM conversations")
def f12(t):
    return t.conversations.select("conv_id", "turn", F.length("text").cast("bigint").alias("text_length"))


@query("f13_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def f13(t):
    return t.orders.select("o_orderkey", dates.date_key("o_orderdate").alias("date_key"))


@query(
    "f14_date_parts",
    """
    SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS BIGINT) AS y, CAST(quarter(l_shipdate) AS BIGINT) AS q, CAST(month(l_shipdate) AS BIGINT) AS m,
           CAST(day(l_shipdate) AS BIGINT) AS d, CAST(dayofyear(l_shipdate) AS BIGINT) AS doy, CAST(weekofyear(l_shipdate) AS BIGINT) AS iso_week,
           CAST(isodow(l_shipdate) AS BIGINT) AS iso_day
    FROM lineitem
    """,
)
def f14(t):
    d = F.col("l_shipdate")
    parts = {
        "y": F.year(d), "q": F.quarter(d), "m": F.month(d), "d": F.dayofmonth(d), "doy": F.dayofyear(d),
        "iso_week": F.weekofyear(d), "iso_day": dates.iso_weekday(d),
    }
    return t.lineitem.select("l_orderkey", "l_linenumber", *[c.cast("bigint").alias(n) for n, c in parts.items()])


@query("f15_names", "SELECT o_orderkey, strftime(o_orderdate, '%A') AS day_name, strftime(o_orderdate, '%B') AS month_name FROM orders")
def f15(t):
    return t.orders.select("o_orderkey", dates.day_name("o_orderdate").alias("day_name"), dates.month_name("o_orderdate").alias("month_name"))


@query(
    "f16_series",
    """
    SELECT CAST(UNNEST(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders
    """,
)
def f16(t):
    return date_span(t.orders, "o_orderdate")


@query(
    "f16_int_series",
    "SELECT o_orderkey, CAST(UNNEST(range(1, CAST(left(o_orderpriority, 1) AS BIGINT) + 1)) AS BIGINT) AS step FROM orders",
)
def f16_int(t):
    level = F.left("o_orderpriority", F.lit(1)).cast("bigint")
    return t.orders.select("o_orderkey", F.explode(F.sequence(F.lit(1).cast("bigint"), level)).alias("step"))


@query("f17_month", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month FROM orders")
def f17(t):
    return t.orders.select("o_orderkey", dates.month_start("o_orderdate").alias("order_month"))


@query(
    "f18_date_arith",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS day_before, CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS due_date,
           o_orderdate + CAST(o_orderkey % 12 AS INTEGER) * INTERVAL 1 HOUR AS paid_at
    FROM orders
    """,
)
def f18(t):
    hours = F.make_dt_interval(hours=F.pmod("o_orderkey", F.lit(12)).cast("int"))
    return t.orders.select(
        "o_orderkey",
        F.date_sub("o_orderdate", 1).alias("day_before"),
        F.date_add("o_orderdate", 30).alias("due_date"),
        (F.col("o_orderdate") + hours).alias("paid_at"),
    )


@query(
    "f19_epoch",
    """
    SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_seconds, date_trunc('second', ts) AS from_epoch,
           date_trunc('second', ts) - INTERVAL 2 HOUR AS from_iso, strptime(strftime(ts, '%d.%m.%Y'), '%d.%m.%Y')::DATE AS from_format
    FROM events
    """,
)
def f19(t):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return t.events.select(
        "event_id",
        seconds.alias("epoch_seconds"),
        F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("from_epoch"),
        dates.parse_iso(iso).cast("timestamp_ntz").alias("from_iso"),
        F.to_date(F.date_format("ts", "dd.MM.yyyy"), "dd.MM.yyyy").alias("from_format"),
    )


@query(
    "f20_duration",
    f"""
    SELECT event_id, seconds, {sql_round('seconds / 60.0::DOUBLE', 1)} AS minutes FROM (
      SELECT event_id, CAST(epoch(date_trunc('second', ts)) - epoch(date_trunc('second', LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS seconds
      FROM events)
    """,
)
def f20(t):
    rows = t.events.select("event_id", "user_id", "ts")
    lagged = lag_in_group(rows, ["user_id"], ["ts", "event_id"], "ts", "previous_ts")
    timed = lagged.select("event_id", dates.seconds_between("previous_ts", "ts").alias("seconds"))
    return timed.withColumn("minutes", numbers.round_half_up(F.col("seconds") / 60.0, 1))


@query(
    "f21_to_date",
    "SELECT event_id, CAST(ts AS DATE) AS day, CAST(year(ts) AS BIGINT) AS y, CAST(month(ts) AS BIGINT) AS m FROM events",
)
def f21(t):
    return t.events.select("event_id", F.to_date("ts").alias("day"), F.year("ts").cast("bigint").alias("y"), F.month("ts").cast("bigint").alias("m"))


@query(
    "f22_math",
    f"""
    SELECT c_custkey, CAST(floor(c_acctbal / 1000) * 1000 AS INTEGER) AS thousands, CAST(c_custkey % 7 AS BIGINT) AS bucket,
           {sql_round('c_acctbal', 1)} AS rounded, {sql_round('c_acctbal / NULLIF(c_nationkey, 0)', 2)} AS per_nation
    FROM customer
    """,
)
def f22(t):
    return t.customer.select(
        "c_custkey",
        numbers.floor_to("c_acctbal", 1000).alias("thousands"),
        F.pmod("c_custkey", F.lit(7)).alias("bucket"),
        numbers.round_half_up("c_acctbal", 1).alias("rounded"),
        numbers.round_half_up(numbers.safe_ratio("c_acctbal", "c_nationkey"), 2).alias("per_nation"),
    )


SHADES = ("amber", "cobalt", "ivory", "jade", "plum", "rust", "slate", "teal", "umber")


@query(
    "f23_array_index",
    f"SELECT p_partkey, {list(SHADES)}[CAST(p_size % {len(SHADES)} + 1 AS BIGINT)] AS shade, {list(SHADES)}[-1] AS last_shade FROM part",
)
def f23(t):
    shades = F.array(*[F.lit(s) for s in SHADES])
    return t.part.select("p_partkey", F.element_at(shades, (F.col("p_size") % len(SHADES) + 1).cast("int")).alias("shade"), F.element_at(shades, -1).alias("last_shade"))


@query(
    "f24_mid",
    f"SELECT CAST(ts AS DATE) AS day, {sql_round('(MAX(value) + MIN(value)) / 2', 1)} AS mid_value FROM events GROUP BY 1",
)
def f24(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(numbers.round_half_up((F.max("value") + F.min("value")) / 2, 1).alias("mid_value"))
