"""Shapes that plans must have to stand 100 TB; broadcasting is switched off, as for tables of that size."""

import re

import pytest

from strataloom.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def large_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _lines(plan):
    return [re.sub(r"^[\s:+\-*()\d]*", "", line) for line in plan.splitlines()]


PREFIXES = ("g", "j", "w", "t", "u", "d07", "d08", "d1", "q", "i01", "i02", "i12", "i15", "x0", "x1", "b")
NAMES = [n for n in QUERIES if n.startswith(PREFIXES)]


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loops_and_no_rows_in_one_task(spark, plan_of, name):
    lines = _lines(plan_of(QUERIES[name](spark, FOLDER)))
    assert not [x for x in lines if x.startswith(("BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython"))]
    for line, below in zip(lines, lines[1:]):
        if line.startswith("Exchange SinglePartition"):
            # Only partial results of aggregates, rows that were limited, or one row per version or partition.
            assert re.match(r"(Object)?HashAggregate\(keys=\[\]|SortAggregate\(keys=\[\]|LocalLimit|TakeOrdered|(Object)?HashAggregate\(keys=\[(_part|version)#", below), below


def test_scan_reads_only_what_is_needed(spark, plan_of):
    plan = plan_of(QUERIES["s04_parquet_scan"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_pruned_folders(spark, plan_of):
    assert "PartitionFilters: [isnotnull(ship_year" in plan_of(QUERIES["i19_pruned"](spark, FOLDER))


def test_flagship_meets_each_shuffle_once(spark, plan_of):
    plan = plan_of(QUERIES["g03_daily_store_sales"](spark, FOLDER))
    assert plan.count("hashpartitioning(l_orderkey") == 1


@pytest.mark.parametrize("name", ["w03_top3_per_day", "w04_latest", "w08_distinct_on", "i09_log_latest", "i15_as_of", "d13_scd1_upsert"])
def test_group_limit_before_the_shuffle(spark, plan_of, name):
    lines = _lines(plan_of(QUERIES[name](spark, FOLDER)))
    kinds = [x.split(" ")[0] for x in lines]
    assert [x for x in lines if x.startswith("WindowGroupLimit") and "Partial" in x]
    assert "Exchange" in kinds


def test_small_literal_tables_are_the_only_forced_broadcasts(spark, plan_of):
    forced = [n for n in NAMES if "BroadcastHashJoin" in plan_of(QUERIES[n](spark, FOLDER))]
    assert set(forced) <= {"j18_holiday", "j18_weekday_name", "w07_row_number_sku", "d15_normalize"}


def test_bucketed_tables_meet_without_a_shuffle(spark, plan_of):
    plan = plan_of(QUERIES["j13_bucketed"](spark, FOLDER))
    assert "Exchange" not in plan and plan.count("SelectedBucketsCount: 16 out of 16") == 2
    assert "SortMergeJoin" in plan


def _files_read(df):
    """Files that the scans of a finished plan opened, by scan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_a_join_decides_which_folders_are_read(spark, plan_of):
    from pyspark.sql import functions as F

    from strataloom.catalog.sourcing import write_lines_by_month
    from strataloom.operators.joins import pruned_by
    from strataloom.sources.files import Tables

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(QUERIES["i19_pruned_by_join"](spark, FOLDER))
        assert "dynamicpruning" in plan and "dynamicpruningexpression(true)" not in plan
        t = Tables(spark, FOLDER)
        lines = spark.read.parquet(write_lines_by_month(t, "dpp"))
        folders = lines.select("ship_year", "ship_month").distinct().count()
        wanted = t.orders.where(F.col("o_orderkey") < 3).select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
        joined = pruned_by(lines, wanted, {"ship_year": "y", "ship_month": "m"})
        for threshold in ("-1", "10m"):  # with a query of its own, and by the broadcast side
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert max(_files_read(joined.select("*"))) <= 9 < folders  # each folder column is pruned by itself
        assert joined.count() == lines.join(wanted.distinct(), (lines["ship_year"] == F.col("y")) & (lines["ship_month"] == F.col("m"))).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_bloom_filter_stands_before_the_shuffle_of_a_large_fact(spark, plan_of):
    from pyspark.sql import functions as F

    from strataloom.operators.joins import pruned_by
    from strataloom.sources.files import Tables

    t = Tables(spark, FOLDER)
    settings = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1KB"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = pruned_by(t.lineitem, t.orders.where(F.col("o_totalprice") > 450000).select("o_orderkey"), {"l_orderkey": "o_orderkey"})
        assert "might_contain" in joined._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert joined.count() == t.lineitem.join(t.orders.where(F.col("o_totalprice") > 450000), F.col("l_orderkey") == F.col("o_orderkey")).count()


def test_checked_lines_are_written_once_for_five_results(spark, plan_of):
    QUERIES["q08_violations"](spark, FOLDER)
    for name in ("q09_issue_summary", "q10_clean", "q11_quarantine", "q12_overview"):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        assert "Join" not in plan and plan.count("FileScan") == 1, name
    assert "PartitionFilters: [isnotnull(rejected" in plan_of(QUERIES["q11_quarantine"](spark, FOLDER))
