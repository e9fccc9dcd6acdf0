"""Skew-proof windows give what plain windows give, also when one key holds a third of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataloom.operators import windows as win


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        user = 1 if i % 3 == 0 else (None if rnd.random() < 0.02 else rnd.randrange(2, 80))
        value = None if rnd.random() < 0.05 else rnd.choice([0.0, -3.5, 12.25, rnd.randrange(-500, 500) / 4])
        data.append((i, user, rnd.randrange(0, 9000) * 60, value))
    df = spark.createDataFrame(data, "id bigint, user int, second bigint, value double")
    return df.select("id", "user", F.timestamp_seconds("second").alias("ts"), "value").cache()


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() > 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_lag_and_lead(rows, partitions):
    w = Window.partitionBy("user").orderBy("ts", "id")
    _same(
        win.lag_in_group(rows, ["user"], ["ts", "id"], "value", "near", partitions),
        rows.withColumn("near", F.lag("value").over(w)),
    )
    _same(
        win.lead_in_group(rows, ["user"], ["ts", "id"], F.col("ts"), "near", partitions),
        rows.withColumn("near", F.lead("ts").over(w)),
    )


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_sum_takes_equal_times_together(rows, partitions):
    w = Window.partitionBy("user").orderBy("ts")
    cents = rows.withColumn("cents", (F.col("value") * 4).cast("bigint"))
    _same(
        win.running_sum_in_group(cents, ["user"], "ts", "cents", "total", partitions),
        cents.withColumn("total", F.sum("cents").over(w)),
    )


def test_burst_of_one_key_is_spread(spark):
    """3,000 rows of one key at one moment, and few others: no partition holds more than its share."""
    rows = spark.range(3000).select("id", F.lit(1).alias("user"), F.lit("2024-01-01").cast("timestamp").alias("ts"))
    others = spark.range(3000, 3100).select("id", F.lit(2).alias("user"), F.timestamp_seconds(F.col("id") * 86400).alias("ts"))
    rows = rows.union(others)
    parts = win.ranged(rows, ["user", "ts", "id"], 8).groupBy("_part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 2 * 3100 / 8
    lagged = win.lag_in_group(rows, ["user"], ["ts", "id"], "id", "near", 8)
    assert lagged.where("near = id - 1").count() == 2999 + 99 and lagged.where("near IS NULL").count() == 2


def test_ranks_of_nan_and_infinity(spark):
    values = [(1, float("nan")), (1, float("inf")), (1, 3.0), (1, None), (1, float("-inf")), (1, float("nan"))]
    rows = spark.createDataFrame(values, "user int, value double")
    got = sorted((r.r, str(r.value)) for r in win.rank_in_group(rows, ["user"], "value", "r", descending=False, partitions=3).collect())
    assert got == [(1, "-inf"), (2, "3.0"), (3, "inf"), (4, "nan"), (4, "nan"), (6, "None")]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("dense", [True, False])
def test_ranks(rows, descending, dense):
    order = F.col("value").desc_nulls_last() if descending else F.col("value").asc_nulls_last()
    fn = F.dense_rank() if dense else F.rank()
    _same(
        win.rank_in_group(rows, ["user"], "value", "r", descending, dense),
        rows.withColumn("r", fn.over(Window.partitionBy("user").orderBy(order)).cast("bigint")),
    )


@pytest.mark.parametrize("partitions", [1, 5])
def test_global_row_number(rows, partitions):
    numbered = win.global_row_number(rows.select("ts", "id"), ["ts", "id"], "n", partitions)
    _same(numbered, rows.select("ts", "id", F.row_number().over(Window.orderBy("ts", "id")).cast("bigint").alias("n")))


def test_top_n_is_limited_before_the_shuffle(rows, plan_of):
    plan = plan_of(win.top_n_per_group(rows, ["user"], [F.desc("ts"), F.asc("id")], 2))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_first_per_key(rows):
    first = win.first_per_key(rows, ["user"], [F.desc("ts"), F.desc("id")])
    w = Window.partitionBy("user").orderBy(F.desc("ts"), F.desc("id"))
    _same(first, rows.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n"))


def test_global_row_number_of_equal_rows(spark):
    many = spark.range(5000).select(F.lit("same").alias("k"))
    numbered = win.global_row_number(many.union(spark.createDataFrame([("a",), ("z",)], "k string")), ["k"], "n", 6)
    got = sorted((r.n, r.k) for r in numbered.collect())
    assert [n for n, _ in got] == list(range(1, 5003))
    assert got[0][1] == "a" and got[-1][1] == "z"
