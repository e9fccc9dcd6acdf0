"""Masks, role views, row and column security, small groups and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.catalog.registry import query
from strataloom.functions import masks
from strataloom.operators.aggregates import union_all
from strataloom.plans import privacy as p
from strataloom.session import new_dir

SQL_PEOPLE = """
    SELECT c_custkey AS user_id, c_name AS full_name,
           CASE WHEN c_acctbal < 0 THEN '' ELSE lower(replace(c_name, '#', '.')) END || '@' || lower(c_mktsegment) || '.example.com' AS email,
           '+372' || lpad(CAST(c_custkey AS VARCHAR), 10, '5') AS phone, c_mktsegment AS city, 'Country ' || c_nationkey AS country,
           CAST(DATE '2020-01-15' + CAST(c_custkey % 900 AS INTEGER) AS DATE) AS registered_on, CAST(floor(c_acctbal) AS INTEGER) AS balance
    FROM customer
"""


def people(t):
    """Customers as persons with contact data."""
    local = F.when(F.col("c_acctbal") < 0, "").otherwise(F.lower(F.translate("c_name", "#", ".")))
    return t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("full_name"),
        F.concat(local, F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com")).alias("email"),
        F.concat(F.lit("+372"), F.lpad(F.col("c_custkey").cast("string"), 10, "5")).alias("phone"),
        F.col("c_mktsegment").alias("city"),
        F.concat(F.lit("Country "), F.col("c_nationkey")).alias("country"),
        F.date_add(F.lit("2020-01-15").cast("date"), F.pmod("c_custkey", F.lit(900)).cast("int")).alias("registered_on"),
        F.floor("c_acctbal").cast("int").alias("balance"),
    )


# The mask shapes, stated by patterns instead of by the string functions that the masks use.
SQL_MASK_EMAIL = r"CASE WHEN regexp_matches(email, '^[^@]+@') THEN regexp_replace(email, '^([^@])[^@]*@([^@]*).*$', '\1***@\2') ELSE '***' END"
SQL_MASK_TEXT = "regexp_extract({0}, '^.') || regexp_replace(substr({0}, 2), '.', '*', 'g')"


@query("x01_mask_email", f"SELECT user_id, {SQL_MASK_EMAIL} AS email, left(email, 1) || '***@' || split_part(email, '@', 2) AS plain FROM ({SQL_PEOPLE})")
def x01(t):
    return people(t).select("user_id", masks.mask_email("email").alias("email"), masks.mask_email_plain("email").alias("plain"))


@query("x02_mask_text", f"SELECT user_id, {SQL_MASK_TEXT.format('full_name')} AS full_name FROM ({SQL_PEOPLE})")
def x02(t):
    return people(t).select("user_id", masks.mask_text("full_name").alias("full_name"))


@query("x03_mask_phone", f"SELECT user_id, left(phone, 4) || ' *** ' || right(phone, 2) AS phone FROM ({SQL_PEOPLE})")
def x03(t):
    return people(t).select("user_id", masks.mask_phone("phone").alias("phone"))


@query("x04_mask_date", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month FROM orders")
def x04(t):
    return t.orders.select("o_orderkey", masks.mask_date("o_orderdate").alias("order_month"))


@query("x05_mask_int", "SELECT c_custkey, CAST(floor(c_acctbal / 1000) * 1000 AS INTEGER) AS balance FROM customer")
def x05(t):
    return t.customer.select("c_custkey", masks.mask_int("c_acctbal").alias("balance"))


@query("x06_redact", "SELECT c_custkey, 'REDACTED' AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer")
def x06(t):
    return t.customer.select("c_custkey", masks.mask_redacted("c_name").alias("c_name"), masks.mask_null("c_acctbal", "double").alias("c_acctbal"))


# What each role sees of a person; other roles get the entry `other`.
PERSON_POLICY = {
    "full_name": {"auditor": "keep", "analyst": "text", "other": "null"},
    "email": {"auditor": "keep", "analyst": "email_plain", "other": "redacted"},
    "phone": {"auditor": "keep", "analyst": "phone", "other": "null"},
    "city": {"auditor": "keep", "analyst": "text", "marketing": "keep", "other": "null"},
    "registered_on": {"auditor": "keep", "other": "date"},
    "balance": {"auditor": "keep", "analyst": "int", "other": "null"},
}
POST_POLICY = {
    "author": {"auditor": "keep", "analyst": "text", "other": "null"},
    "body": {"auditor": "keep", "analyst": "keep", "other": "null"},
}


@query("x07_role_auditor", SQL_PEOPLE)
def x07_auditor(t):
    return p.secure_view(people(t), PERSON_POLICY, ["analyst", "auditor"], keep=["user_id", "country"])


@query(
    "x07_role_analyst",
    f"""
    SELECT user_id, {SQL_MASK_TEXT.format('full_name')} AS full_name, left(email, 1) || '***@' || split_part(email, '@', 2) AS email,
           left(phone, 4) || ' *** ' || right(phone, 2) AS phone, {SQL_MASK_TEXT.format('city')} AS city, country,
           CAST(date_trunc('month', registered_on) AS DATE) AS registered_on, CAST(floor(balance / 1000) * 1000 AS INTEGER) AS balance FROM ({SQL_PEOPLE})
    """,
)
def x07_analyst(t):
    return p.secure_view(people(t), PERSON_POLICY, ["analyst"], keep=["user_id", "country"])


@query(
    "x07_role_marketing",
    f"""
    SELECT user_id, CAST(NULL AS VARCHAR) AS full_name, 'REDACTED' AS email, CAST(NULL AS VARCHAR) AS phone, city, country,
           CAST(date_trunc('month', registered_on) AS DATE) AS registered_on, CAST(NULL AS INTEGER) AS balance FROM ({SQL_PEOPLE})
    """,
)
def x07_marketing(t):
    return p.secure_view(people(t), PERSON_POLICY, ["marketing"], keep=["user_id", "country"])


@query(
    "x07_posts_by_role",
    f"""
    SELECT 'analyst' AS role, doc_id, {SQL_MASK_TEXT.format("lang || '/' || source")} AS author, text AS body, n_chars AS body_length FROM documents
    UNION ALL SELECT 'marketing', doc_id, NULL, NULL, n_chars FROM documents
    """,
)
def x07_posts(t):
    posts = t.documents.select("doc_id", F.concat_ws("/", "lang", "source").alias("author"), F.col("text").alias("body"), F.col("n_chars").alias("body_length"))
    return union_all([p.secure_view(posts, POST_POLICY, [role], keep=["doc_id", "body_length"]).select(F.lit(role).alias("role"), "*") for role in ("analyst", "marketing")])


@query("x08_region_rows", f"SELECT user_id, full_name, country FROM ({SQL_PEOPLE}) WHERE country = 'Country 7'")
def x08(t):
    return p.region_rows(people(t).select("user_id", "full_name", "country"), "country", "Country 7")


@query("x08_unset", f"SELECT user_id, full_name, country FROM ({SQL_PEOPLE}) WHERE FALSE")
def x08_unset(t):
    return p.region_rows(people(t).select("user_id", "full_name", "country"), "country", None)


@query("x09_short_rows", "SELECT doc_id, n_chars FROM documents WHERE n_chars < 200")
def x09(t):
    return t.documents.where("n_chars < 200").select("doc_id", "n_chars")


GRANTED = ["user_id", "full_name", "city", "country", "registered_on"]


@query("x10_columns", f"SELECT user_id, city FROM ({SQL_PEOPLE})")
def x10(t):
    return p.allowed_columns(people(t), GRANTED, ["user_id", "city"])


@query("x17_regional_view", f"SELECT {', '.join(GRANTED)} FROM ({SQL_PEOPLE}) WHERE country = 'Country 3'")
def x17(t):
    return p.regional_view(people(t), "country", "Country 3", GRANTED)


@query(
    "x11_aggregate_only",
    f"SELECT city, country, COUNT(*) AS person_count, MIN(registered_on) AS first_registered, MAX(registered_on) AS last_registered FROM ({SQL_PEOPLE}) GROUP BY ALL",
)
def x11(t):
    return people(t).groupBy("city", "country").agg(
        F.count("*").alias("person_count"), F.min("registered_on").alias("first_registered"), F.max("registered_on").alias("last_registered")
    )


SQL_GROUPS = "SELECT c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 1000) AS BIGINT) AS balance_band, COUNT(*) AS n FROM customer GROUP BY ALL"


def _bands(t):
    return t.customer.select("c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 1000).cast("bigint").alias("balance_band"))


@query("x12_k_anonymity", f"SELECT c_nationkey, c_mktsegment, balance_band, n AS row_count FROM ({SQL_GROUPS}) WHERE n < 3")
def x12(t):
    return p.small_groups(_bands(t), ["c_nationkey", "c_mktsegment", "balance_band"], 3)


@query("x12_suppressed", f"SELECT c_nationkey, c_mktsegment, balance_band, CASE WHEN n >= 3 THEN n END AS row_count FROM ({SQL_GROUPS})")
def x12_suppressed(t):
    return p.suppressed_counts(_bands(t), ["c_nationkey", "c_mktsegment", "balance_band"], 3)


# Register of personal data, and how its categories are handled.
PII_REGISTER = {
    "user_id": "indirect",
    "full_name": "direct",
    "email": "direct",
    "phone": "direct",
    "city": "indirect",
    "country": "none",
    "registered_on": "indirect",
}
PII_HANDLING = {"direct": "redacted", "indirect": "keep", "none": "keep", "email": "email", "registered_on": "date"}


@query(
    "x13_register_masking",
    f"""
    SELECT user_id, 'REDACTED' AS full_name, {SQL_MASK_EMAIL} AS email, 'REDACTED' AS phone, city, country,
           CAST(date_trunc('month', registered_on) AS DATE) AS registered_on FROM ({SQL_PEOPLE})
    """,
)
def x13(t):
    return p.mask_by_register(people(t), PII_REGISTER, PII_HANDLING)


SQL_GRANTS = "SELECT DISTINCT c_mktsegment AS role_name, n_name AS object_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 8000"


def _grants(t):
    """A grant list taken from the data: a segment may read a nation in which it has a rich customer."""
    rich = t.customer.where("c_acctbal > 8000").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rich.select(F.col("c_mktsegment").alias("role_name"), F.col("n_name").alias("object_name")).distinct()


@query(
    "x14_privileges",
    f"""
    WITH g AS ({SQL_GRANTS}) SELECT r.role_name, o.object_name, g.role_name IS NOT NULL AS can_select
    FROM (SELECT DISTINCT role_name FROM g) r CROSS JOIN (SELECT DISTINCT object_name FROM g) o
    LEFT JOIN g ON g.role_name = r.role_name AND g.object_name = o.object_name
    """,
)
def x14(t):
    return p.privilege_matrix(_grants(t))


@query("x15_forbidden_column", f"SELECT * FROM ({SQL_GRANTS}) WHERE role_name = 'BUILDING' AND object_name IN ('NATION_1', 'NATION_2')")
def x15(t):
    return p.forbidden_grants(_grants(t), (F.col("role_name") == "BUILDING") & F.col("object_name").isin("NATION_1", "NATION_2"))


@query(
    "x16_audit",
    """
    SELECT object_name, COUNT(*) AS reads, COUNT(*) FILTER (event_type = 'click') AS reads_naming_word
    FROM (SELECT event_type, CASE WHEN user_id % 3 = 0 THEN 'marts.dim_users' ELSE 'secured.vw_dim_users' END AS object_name FROM events WHERE event_type <> 'error')
    GROUP BY 1
    """,
)
def x16(t):
    """Events written as audit lines between other log lines, then read back from text."""
    table = F.when(F.pmod("user_id", F.lit(3)) == 0, "marts.dim_users").otherwise("secured.vw_dim_users")
    columns = F.when(F.col("event_type") == "click", 'first_name, email AS ""mail""').otherwise("first_name, emailed_at")
    kind = F.when(F.col("event_type") == "error", "WRITE,UPDATE,TABLE").otherwise("READ,SELECT,VIEW")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" LOG:  AUDIT: SESSION,"), "event_id", F.lit(",1,"), kind, F.lit(","), table,
        F.lit(',"SELECT '), columns, F.lit(" FROM "), table, F.lit('",<none>'),
    )
    path = new_dir(t.spark, "x16")
    lines = t.events.select(F.explode(F.array(line, F.lit("LOG:  checkpoint complete, wrote 3 buffers"))).alias("value"))
    lines.write.text(path)
    return p.reads_per_object(p.parse_audit(t.spark.read.text(path)), "email")
