import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataloom.functions.text import blank_to_null
from strataloom.operators.joins import asof_join
from strataloom.plans import quality as q
from strataloom.plans.scd import scd2_from_snapshots


@pytest.fixture(scope="module")
def checked(spark):
    """20 orders on 5 days; one defect per day, the second day's one hits two rows."""
    month = dt.date(2026, 4, 1)
    products = spark.createDataFrame([(month, f"P-{i}", 10.0 * i) for i in (1, 2, 3, 4)], "month date, product string, base double")
    orders = []
    for day in range(1, 6):
        for n in range(1, 5):
            orders.append([f"O-{day}-{n}", dt.date(2026, 4, day), "S-1", f"P-{n}", 2, 10.0 * n])
    orders[1][3] = "P-999"
    orders[6][0] = orders[5][0]
    orders[9][2] = "  "
    orders[14][4] = 0
    orders[17][5] = 999.99
    base = spark.createDataFrame([(i, *o) for i, o in enumerate(orders)], "id int, order_id string, day date, store string, item string, quantity int, price double")
    base = q.mark_duplicates(base.withColumn("clean_id", blank_to_null("order_id")), "clean_id", "repeated")
    versions = scd2_from_snapshots(products, "product", "month", ["base"])
    joined = asof_join(base, versions, "item", "day", "product", how="left")
    near = F.col("price").between(F.col("base") - 2, F.col("base") + 2)
    rules = [
        q.Rule("order_id_duplicate", F.col("repeated"), "repeated", F.col("order_id")),
        q.Rule("store_id_missing", blank_to_null("store").isNull(), "no store", F.coalesce("store", F.lit("<NULL>"))),
        q.Rule("quantity_must_be_positive", F.col("quantity").isNull() | (F.col("quantity") <= 0), "quantity", F.col("quantity").cast("string")),
        q.Rule("product_must_exist", F.col("version_key").isNull(), "no product", F.col("item")),
        q.Rule("price_close", F.col("version_key").isNotNull() & (F.col("price").isNull() | ~near), "price", F.col("price").cast("string")),
    ]
    return q.apply_rules(joined, rules).cache(), rules


def test_overview_counts(checked):
    row = q.overview(checked[0]).first()
    assert (row.raw_rows, row.clean_rows, row.rejected_rows, row.rule_failures, row.rejected_pct) == (20, 14, 6, 6, 30.0)


def test_violations_name_row_rule_and_value(checked):
    got = {(r.id, r.rule_name, r.failed_value) for r in q.violations(*checked, ["id"]).collect()}
    assert got == {
        (1, "product_must_exist", "P-999"),
        (5, "order_id_duplicate", "O-2-2"),
        (6, "order_id_duplicate", "O-2-2"),
        (9, "store_id_missing", "  "),
        (14, "quantity_must_be_positive", "0"),
        (17, "price_close", "999.99"),
    }
    assert {(r.rule_name, r.failed_rows) for r in q.issue_summary(*checked).collect()} == {
        ("product_must_exist", 1), ("order_id_duplicate", 2), ("store_id_missing", 1), ("quantity_must_be_positive", 1), ("price_close", 1)
    }


def test_clean_and_quarantine_split_all_rows(checked):
    clean = {r.id for r in q.clean_rows(checked[0]).collect()}
    bad = {r.id: r.failed_rules for r in q.quarantine(*checked, ["id"]).collect()}
    assert clean | set(bad) == set(range(20)) and not clean & set(bad)
    assert bad[9] == "store_id_missing"


def test_several_rules_are_listed_in_order(spark):
    df = spark.createDataFrame([(1, None)], "id int, x int")
    rules = [q.Rule("z", F.lit(True), "", F.lit("")), q.Rule("a", F.col("x").isNull(), "", F.lit("")), q.Rule("n", F.col("x") > 1, "", F.lit(""))]
    assert q.quarantine(q.apply_rules(df, rules), rules, ["id"]).first().failed_rules == "a, z"


def test_null_key_is_no_duplicate(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in q.duplicates(df, ["k"]).collect()] == [(1, 2)]
    assert q.mark_duplicates(df, "k", "again").where("again").count() == 2


def test_suite(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    got = {tuple(r) for r in q.run_suite({"unique": q.duplicates(df, ["k"]), "null": q.nulls(df, "k")}).collect()}
    assert got == {("unique", "fail", 1), ("null", "pass", 0)}


def test_profile_of_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (3, "bcd")], "n int, s string")
    got = {r.column_name: r for r in q.profile(df).collect()}
    assert (got["n"].distinct_pct, got["n"].unique_pct, got["n"].mean_number) == (66.67, 33.33, 1.6667)
    assert (got["s"].null_pct, got["s"].min_length, got["s"].max_length, got["s"].mean_length) == (33.33, 1, 3, 2.0)


def test_registry_updates_by_name(spark):
    asset = dict(asset_name="t", asset_layer="l", asset_type="table", owner_name="a", refresh_frequency="f", source_system="s", contains_personal_data=False)
    old = q.asset_rows(spark, [asset, dict(asset, asset_name="u")])
    new = q.asset_rows(spark, [dict(asset, owner_name="b")])
    assert {(r.asset_name, r.owner_name) for r in q.register_assets(old, new).collect()} == {("t", "b"), ("u", "a")}


def test_duplicates_within_a_key_equal_duplicates(spark):
    rows = [(1, 1, "a"), (1, 1, "a"), (1, 2, "a"), (2, 1, "a"), (2, None, None), (2, None, None), (3, None, "a"), (3, 1, None)]
    df = spark.createDataFrame(rows, "k int, n int, s string")
    plain, shared = (sorted(map(str, q.mark_duplicates(df, F.struct("k", "n", "s"), "again", **more).collect())) for more in ({}, {"within": "k"}))
    assert shared == plain and sum("True" in r for r in shared) == 4


def test_lines_move_once_to_their_orders_and_once_to_their_parts(spark, plan_of):
    """Without broadcasts two of the exchanges carry the supplier, which only the lines have."""
    from strataloom.catalog.quality import checked_lines
    from strataloom.sources.files import Tables

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.maxMetadataStringLength": "10000"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        checked, _ = checked_lines(Tables(spark, "/root/testdata/sf0.001"))
        text = checked._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    moved = [line for i, line in enumerate(text) if "Exchange hashpartitioning" in line and "l_suppkey" in "".join(text[i + 1 : i + 2])]
    assert len(moved) == 2, "\n".join(text)
