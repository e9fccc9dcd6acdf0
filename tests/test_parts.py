"""Results that can be added up: bitmaps of ids and sketches of columns."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from strataloom.operators import bitmaps
from strataloom.plans import sketches


def test_distinct_counts_of_any_span(spark):
    rnd = random.Random(3)
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=rnd.randrange(20)), rnd.choice([rnd.randrange(60), rnd.randrange(40_000, 90_000)])) for _ in range(600)]
    rows += [(start, None), (None, 5), (start + dt.timedelta(days=30), 2**40)]
    df = spark.createDataFrame(rows, "day date, id bigint")
    stored = bitmaps.id_bitmaps(df, ["day"], "id").cache()
    for lo, hi in ((0, 0), (3, 9), (0, 30)):
        span = F.col("day").between(F.lit(start + dt.timedelta(days=lo)), F.lit(start + dt.timedelta(days=hi)))
        assert bitmaps.distinct_count(stored.where(span)).first()[0] == df.where(span).select("id").dropna().distinct().count()
    assert bitmaps.distinct_count(stored.where("false")).first()[0] == 0
    got = {r.day: r.n for r in bitmaps.trailing_distinct(stored.where("day is not null"), "day", 5, "n").collect()}
    days = {d for d, i in rows if d is not None and i is not None}
    assert got == {d: len({i for e, i in rows if e and i is not None and d - dt.timedelta(days=4) <= e <= d}) for d in days}


@pytest.fixture
def table(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(20_000):
        rows.append((dt.date(2024, 1, 1 + i % 10), 2**53 + 1 + i // 2, decimal.Decimal(rnd.randrange(10**6)) / 100, rnd.gauss(0, 10) if i % 7 else None, "v%d" % (i % 3000), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)))
    schema = "day date, big bigint, money decimal(12,2), x double, s string, at timestamp"
    return spark.createDataFrame(rows, schema), rows


def test_merged_profile_equals_the_whole_one(spark, table):
    df, rows = table
    names = ["big", "money", "x", "s", "at", "day"]
    old = sketches.profile_parts(df.where("day < '2024-01-08'"), ["day"], names)
    new = sketches.profile_parts(df.where("day >= '2024-01-08'"), ["day"], names)
    merged = sketches.merge_parts(old.unionByName(new))
    got = {r.column_name: r for r in sketches.read_profile(merged, [0.05, 0.5, 0.95]).collect()}
    assert got["big"].min_exact == 2**53 + 1 and got["big"].max_exact == 2**53 + 10_000  # digits that a double would lose
    assert (got["day"].min_time.date(), got["day"].max_time.date()) == (dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    assert got["money"].mean_exact == float(round(sum(r[2] for r in rows) / len(rows), 4))
    assert got["x"].value_count == sum(r[3] is not None for r in rows) and got["x"].null_pct == 14.29
    assert (got["s"].min_length, got["s"].max_length) == (2, 5) and got["s"].q50 is None
    # the errors of the sketches, against the exact values
    exact = {c: len({r[i] for r in rows} - {None}) for c, i in (("big", 1), ("money", 2), ("s", 4), ("at", 5))}
    for c, n in exact.items():
        assert abs(got[c].distinct_about - n) <= 0.04 * n, c
    values = sorted(r[3] for r in rows if r[3] is not None)
    for q in (5, 50, 95):
        rank = sum(v <= got["x"][f"q{q}"] for v in values) / len(values)
        assert abs(rank - q / 100) < 0.02, q
    parts = sketches.read_profile(sketches.merge_parts(old, ["day"]))
    assert parts.where("column_name = 'big'").count() == 7 and "day" in parts.columns
    assert sketches.read_profile(sketches.profile_parts(df.where("false"), ["day"], names)).count() == 0
