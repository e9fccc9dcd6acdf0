import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from strataloom.operators import joins


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("grain", ["year", "month"])
def test_asof_against_brute_force(spark, how, grain):
    rnd = random.Random(3)
    start = dt.date(2019, 11, 1)
    facts = [(i, None if i % 50 == 0 else (1 if i % 3 == 0 else rnd.randrange(2, 9)), start + dt.timedelta(days=rnd.randrange(900))) for i in range(600)]
    facts.append((1000, 1, None))
    versions = []
    for key in range(1, 8):
        cuts = sorted({start + dt.timedelta(days=rnd.randrange(-200, 1000)) for _ in range(6)})
        for a, b in zip(cuts, [c - dt.timedelta(days=1) for c in cuts[1:]] + [dt.date(9999, 12, 31)]):
            versions.append((key, f"{key}:{a}", a, b))
    f = spark.createDataFrame(facts, "id int, k int, day date")
    v = spark.createDataFrame(versions, "vk int, version string, valid_from date, valid_to date")
    got = sorted((r.id, r.version) for r in joins.asof_join(f, v, "k", "day", "vk", how=how, grain=grain).collect() if True)
    want = []
    for i, k, day in facts:
        hits = [x[1] for x in versions if x[0] == k and day and x[2] <= day <= x[3]]
        want += [(i, h) for h in hits] or ([(i, None)] if how == "left" else [])
    assert sorted(got, key=str) == sorted(want, key=str)


def test_reconcile_ignores_case_blanks_and_nulls(spark):
    a = spark.createDataFrame([(" A@x ",), ("b@x",), (None,), ("a@x",)], "e string")
    b = spark.createDataFrame([("a@X",), ("c@x",), (None,)], "m string")
    got = {(r.key_value, r.status) for r in joins.reconcile_keys(a, b, "e", "m").collect()}
    assert got == {("a@x", "matched"), ("b@x", "left_only"), ("c@x", "right_only")}


def test_match_count_equals_join(spark):
    a = spark.range(100).select(F.pmod("id", F.lit(3)).alias("x"))
    b = spark.range(50).select(F.pmod("id", F.lit(4)).alias("y"))
    assert joins.match_count(a, b, "x", "y").first()[0] == a.join(b, F.col("x") == F.col("y")).count()
    assert joins.match_count(a, b.where("y > 9"), "x", "y").first()[0] == 0


def test_inline_rows_need_no_join(spark, plan_of):
    df = joins.with_inline_rows(spark.range(4), [Row(n=1, name="a"), Row(n=2, name="b")])
    assert df.count() == 8
    assert "Join" not in plan_of(df) and "CartesianProduct" not in plan_of(df)


def test_lookup_row_is_empty_when_a_key_is_missing(spark):
    df = spark.range(5)
    assert joins.lookup_row(spark, a=(df, "id"), b=(df.where("id > 2"), "id")).first() == Row(a=0, b=3)
    assert joins.lookup_row(spark, a=(df, "id"), b=(df.where("id > 9"), "id")).count() == 0


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "k int")
    assert [r.id for r in joins.orphans(child, parent, "fk", "k").collect()] == [3]


def test_first_match_takes_the_smallest(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 9), (1, 4)], "j int, e int")
    assert {(r.k, r.e) for r in joins.first_match(left, right, "k", "j", "e", "e").collect()} == {(1, 4), (2, None)}


def test_left_join_of_a_hot_right_side(spark):
    left = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 7), (3, 8)], "j int, v int")
    got = joins.left_join_many(left, right, "k", "j")
    plain = left.join(right, F.col("k") == F.col("j"), "left")
    assert got.columns == plain.columns
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0 and got.count() == 53
    assert sorted((r.k for r in joins.without_match(left, right, "k", "j").collect()), key=str) == [2, 2, None]


def test_order_without_customer_keeps_its_row(spark):
    from types import SimpleNamespace

    from strataloom.catalog.joining import j15

    t = SimpleNamespace(
        orders=spark.createDataFrame([(1, 10), (2, 99)], "o_orderkey int, o_custkey int"),
        customer=spark.createDataFrame([(10, 5)], "c_custkey int, c_nationkey int"),
        supplier=spark.createDataFrame([(7, 5), (8, 5)], "s_suppkey int, s_nationkey int"),
    )
    assert {tuple(r) for r in j15(t).collect()} == {(1, 7), (2, None)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_by_key_equals_asof_by_year(spark, how):
    """Overlapping, undated and repeated versions, keys without versions, undated and repeated facts."""
    day = dt.date
    facts = [(1, 1, day(2020, 3, 1)), (1, 1, day(2020, 3, 1)), (2, 1, day(2021, 3, 1)), (3, 1, day(2019, 1, 1)), (4, 2, day(2020, 1, 1)), (5, None, day(2020, 1, 1)), (6, 1, None), (7, 9, day(2020, 5, 5))]
    versions = [(1, "a", day(2020, 1, 1), day(2020, 12, 31)), (1, "b", day(2020, 2, 1), day(9999, 12, 31)), (1, "c", None, day(2020, 1, 1)), (2, "d", day(2020, 1, 1), day(2020, 1, 1)), (2, "d", day(2020, 1, 1), day(2020, 1, 1)), (None, "e", day(2020, 1, 1), day(9999, 12, 31))]
    f = spark.createDataFrame(facts, "id int, k int, day date")
    v = spark.createDataFrame(versions, "vk int, version string, valid_from date, valid_to date")
    by_year = joins.asof_join(f, v, "k", "day", "vk", how=how)
    by_key = joins.asof_join(f, v, "k", "day", "vk", how=how, grain="key")
    assert by_key.columns == by_year.columns
    assert sorted(map(str, by_key.collect())) == sorted(map(str, by_year.collect()))
