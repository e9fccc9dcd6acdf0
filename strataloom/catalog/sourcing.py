"""Sources and sinks: every table makes the round trip through files or named tables."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F

from strataloom.catalog.registry import query, sql_mean, sql_round, sql_total
from strataloom.functions.numbers import mean, total
from strataloom.operators.aggregates import union_all
from strataloom.session import new_dir
from strataloom.sources import files, sinks
from strataloom.sources.versioned import DayTable

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("s01_csv_scan", "SELECT * FROM customer")
def s01(t):
    path = sinks.write_csv(t.customer, new_dir(t.spark, "s01"))
    return files.read_csv(t.spark, path, CUSTOMER)


@query("s02_csv_sep", "SELECT * FROM supplier")
def s02(t):
    path = sinks.write_csv(t.supplier, new_dir(t.spark, "s02"), sep=";")
    return files.read_csv(t.spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", sep=";")


@query("s03_csv_infer", "SELECT * FROM part")
def s03(t):
    path = sinks.write_csv(t.part, new_dir(t.spark, "s03"))
    inferred = files.read_csv(t.spark, path)
    return inferred.select(*[F.col(f.name).cast(f.dataType) for f in t.part.schema.fields])


@query("s04_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'")
def s04(t):
    return t.orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_totalprice")


@query("s05_json_scan", "SELECT * FROM customer")
def s05(t):
    path = sinks.write_json(t.customer, new_dir(t.spark, "s05"))
    return files.read_json(t.spark, path, CUSTOMER)


@query("s06_json_flatten", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def s06(t):
    parsed = t.events.select("event_id", files.parse_payload("props", "k bigint").alias("payload"))
    return files.flatten(parsed, {"event_id": "event_id", "k": "payload.k"})


@query(
    "s07_first_elem",
    "SELECT vec_id, CAST(COALESCE(embedding[1], 0) AS DOUBLE) AS first_value FROM embeddings",
)
def s07(t):
    return t.embeddings.select("vec_id", files.first_element("embedding", 0.0).cast("double").alias("first_value"))


@query(
    "s07_first_key",
    "SELECT event_id, COALESCE(json_keys(props)[1], 'none') AS first_key FROM events",
)
def s07_key(t):
    payload = files.parse_payload("props", "map<string,bigint>")
    return t.events.select("event_id", files.first_map_key(payload, "none").alias("first_key"))


@query(
    "s08_arrays_zip",
    """
    SELECT vec_id, CAST(pos AS BIGINT) AS pos, CAST(embedding[pos] AS DOUBLE) AS value
    FROM (SELECT vec_id, embedding, UNNEST(range(1, len(embedding) + 1)) AS pos FROM embeddings)
    """,
)
def s08(t):
    arrays = {"pos": F.sequence(F.lit(1), F.size("embedding")), "value": F.col("embedding")}
    rows = files.arrays_to_rows(t.embeddings, arrays, ["vec_id"])
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.col("value").cast("double").alias("value"))


def _layer(t, label: str) -> str:
    location = new_dir(t.spark, label)
    return sinks.use_layer(t.spark, location.rsplit("/", 1)[1].replace("-", "_"), location)


@query("s09_table_scan", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def s09(t):
    layer = _layer(t, "staging")
    sinks.save_table(t.orders, f"{layer}.orders")
    return t.spark.table(f"{layer}.orders").select("o_orderkey", "o_custkey", "o_orderstatus")


# Service level of each order priority.
PRIORITY_LEVELS = [
    Row(priority="1-URGENT", service="same day"),
    Row(priority="2-HIGH", service="next day"),
    Row(priority="3-MEDIUM", service="week"),
    Row(priority="5-LOW", service="month"),
]


@query(
    "s10_values",
    """
    SELECT service, COUNT(*) AS order_count
    FROM orders JOIN (VALUES ('1-URGENT', 'same day'), ('2-HIGH', 'next day'), ('3-MEDIUM', 'week'), ('5-LOW', 'month'))
      AS v(priority, service) ON o_orderpriority = priority
    GROUP BY service
    """,
)
def s10(t):
    levels = t.spark.createDataFrame(PRIORITY_LEVELS)
    return t.orders.join(levels, F.col("o_orderpriority") == F.col("priority")).groupBy("service").agg(F.count("*").alias("order_count"))


@query(
    "s11_preview_count",
    """
    SELECT CAST(position AS BIGINT) AS position, column_name, data_type, row_count
    FROM (VALUES (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'), (3, 'o_orderstatus', 'string'),
                 (4, 'o_totalprice', 'double'), (5, 'o_orderdate', 'timestamp_ntz'), (6, 'o_orderpriority', 'string'))
         AS s(position, column_name, data_type)
    CROSS JOIN (SELECT COUNT(*) AS row_count FROM orders)
    """,
)
def s11(t):
    return files.schema_rows(t.orders).withColumn("position", F.col("position").cast("bigint"))


@query(
    "s12_period_files",
    f"""
    SELECT strftime(o_orderdate, '%Y') AS period, COUNT(*) AS order_count, {sql_total('o_totalprice')} AS total_price
    FROM orders GROUP BY 1
    """,
)
def s12(t):
    root = new_dir(t.spark, "s12")
    by_year = t.orders.withColumn("file_year", F.year("o_orderdate"))
    sinks.write_partitioned(by_year, root, ["file_year"])
    years = [r[0] for r in by_year.select("file_year").distinct().collect()]
    loaded = files.read_period_files(t.spark, [f"{root}/file_year={y}" for y in sorted(years)], r"file_year=(\d{4})", "period")
    return loaded.groupBy("period").agg(F.count("*").alias("order_count"), total("o_totalprice").alias("total_price"))


@query("k01_full_refresh", "SELECT * FROM nation UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def k01(t):
    path = new_dir(t.spark, "k01")
    source = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    rows = t.nation.toDF("n_nationkey", "n_name", "n_regionkey").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name", "n_regionkey")
    both = rows.union(source)
    sinks.full_refresh(both, path)
    return sinks.full_refresh(both, path)


@query("k02_roundtrip", "SELECT 'csv' AS format, * FROM part UNION ALL SELECT 'parquet' AS format, * FROM part")
def k02(t):
    csv = files.read_csv(t.spark, sinks.write_csv(t.part, new_dir(t.spark, "k02csv")), t.part.schema)
    parquet = sinks.full_refresh(t.part, new_dir(t.spark, "k02parquet"))
    return union_all([csv.select(F.lit("csv").alias("format"), "*"), parquet.select(F.lit("parquet").alias("format"), "*")])


@query(
    "k03_partitioned_write",
    f"""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS ship_month,
           COUNT(*) AS line_count, {sql_total('l_quantity')} AS quantity
    FROM lineitem GROUP BY 1, 2
    """,
)
def k03(t):
    path = write_lines_by_month(t, "k03")
    return t.spark.read.parquet(path).groupBy("ship_year", "ship_month").agg(F.count("*").alias("line_count"), total("l_quantity").alias("quantity"))


def write_lines_by_month(t, label: str) -> str:
    lines = t.lineitem.withColumns({"ship_year": F.year("l_shipdate"), "ship_month": F.month("l_shipdate")})
    return sinks.write_partitioned(lines, new_dir(t.spark, label), ["ship_year", "ship_month"])


@query(
    "k04_save_as_table",
    f"""
    SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS order_count, {sql_mean('o_totalprice')} AS avg_price
    FROM orders GROUP BY 1
    """,
)
def k04(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count("*").alias("order_count"), mean("o_totalprice").alias("avg_price")
    )
    return sinks.save_table(daily, f"{_layer(t, 'analytics')}.daily_orders")


@query(
    "k05_partition_replace",
    f"""
    SELECT event_id, CASE WHEN CAST(ts AS DATE) = (SELECT CAST(MAX(ts) AS DATE) FROM events) THEN {sql_round('value * 2', 2)}
           ELSE value END AS value, CAST(ts AS DATE) AS day
    FROM events
    """,
)
def k05(t):
    path = new_dir(t.spark, "k05")
    rows = t.events.select("event_id", "value", F.to_date("ts").alias("day"))
    table = DayTable(t.spark, path, "day", rows.schema)
    table.replace(rows)
    last = rows.agg(F.max("day")).first()[0]
    corrected = table.read([last]).withColumn("value", F.round((F.col("value") * 2).cast("decimal(28,8)"), 2).cast("double"))
    table.replace(corrected, [last])
    return table.read()


@query("k06_insert_select", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def k06(t):
    view = t.customer.where("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal")
    loaded = sinks.full_refresh(sinks.stamped(view), new_dir(t.spark, "k06"))
    return loaded.where(F.col("loaded_at").isNotNull()).drop("loaded_at")
