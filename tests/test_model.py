import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataloom.plans import dims, scd

D = dt.date


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.fixture
def products(spark):
    """Two monthly snapshots: 4 and 5 products, one renamed, one repriced, one new."""
    march = [("P-100", "Tea", 4.5), ("P-200", "Coffee", 9.9), ("P-300", "Cup", 3.0), ("P-400", "Pot", 20.0)]
    april = [("P-100", "Green tea", 4.5), ("P-200", "Coffee", 10.5), ("P-300", "Cup", 3.0), ("P-400", "Pot", 20.0), ("P-500", "Tray", 7.0)]
    rows = [(D(2026, 3, 1), *p) for p in march] + [(D(2026, 4, 1), *p) for p in april]
    return spark.createDataFrame(rows, "month date, product string, name string, price double")


def test_snapshots_give_one_version_each(products):
    versions = scd.scd2_from_snapshots(products, "product", "month", ["name", "price"])
    assert versions.count() == 9
    assert versions.where("is_current").count() == 5
    tea = _rows(versions.where("product = 'P-100'"), "version_key", "name", "valid_from", "valid_to", "is_current")
    assert tea == [
        ("P-100:2026-03-01", "Tea", D(2026, 3, 1), D(2026, 3, 31), False),
        ("P-100:2026-04-01", "Green tea", D(2026, 4, 1), D(9999, 12, 31), True),
    ]
    assert scd.overlaps(versions, "product").count() == 0


def test_missing_snapshot_stretches_the_version_before(spark):
    rows = [(D(2026, 1, 1), "a", 1), (D(2026, 3, 1), "a", 2)]
    versions = scd.scd2_from_snapshots(spark.createDataFrame(rows, "m date, k string, v int"), "k", "m", ["v"])
    assert _rows(versions, "valid_from", "valid_to")[0] == (D(2026, 1, 1), D(2026, 2, 28))


@pytest.fixture
def people(spark):
    rows = [(1, "Tartu", "Ann"), (2, None, "Bo"), (3, "Narva", "Cy")]
    return scd.scd2_initial(spark.createDataFrame(rows, "id int, city string, name string"), ["id"], ["city", "name"], "2025-01-01")


def _merge(dim, rows, day):
    source = dim.sparkSession.createDataFrame(rows, "id int, city string, name string")
    return scd.scd2_merge(dim, source, ["id"], ["city"], day)


def test_late_change_is_refused_and_null_keys_are_kept_once(people):
    with pytest.raises(Exception, match="before the open version"):
        _merge(people, [(1, "Parnu", "Ann")], "2024-06-01").collect()
    once = _merge(people, [(None, "Voru", "No")], "2025-06-01")
    again = _merge(once, [(None, "Voru", "No")], "2025-07-01")
    assert once.where("id IS NULL").count() == 1 and again.where("id IS NULL").count() == 1


def test_merge_closes_adds_and_keeps(people):
    merged = _merge(people, [(1, "Parnu", "Ann"), (2, None, "Bob"), (4, "Valga", "Di")], "2025-06-01")
    assert _rows(merged, "id", "city", "name", "valid_from", "valid_to", "is_current") == [
        (1, "Parnu", "Ann", D(2025, 6, 1), D(9999, 12, 31), True),
        (1, "Tartu", "Ann", D(2025, 1, 1), D(2025, 5, 31), False),
        (2, None, "Bo", D(2025, 1, 1), D(9999, 12, 31), True),
        (3, "Narva", "Cy", D(2025, 1, 1), D(9999, 12, 31), True),
        (4, "Valga", "Di", D(2025, 6, 1), D(9999, 12, 31), True),
    ]


def test_merge_again_changes_nothing(people):
    rows = [(1, "Parnu", "Ann"), (2, "Keila", "Bo")]
    once = _merge(people, rows, "2025-06-01")
    for day in ("2025-06-01", "2025-07-01"):
        assert _rows(_merge(once, rows, day), *once.columns) == _rows(once, *once.columns)


def test_second_change_on_one_day_replaces_the_version(people):
    once = _merge(people, [(1, "Parnu", "Ann")], "2025-06-01")
    twice = _merge(once, [(1, "Rakvere", "Ann")], "2025-06-01")
    assert _rows(twice.where("id = 1"), "city", "valid_from", "valid_to") == [
        ("Rakvere", D(2025, 6, 1), D(9999, 12, 31)),
        ("Tartu", D(2025, 1, 1), D(2025, 5, 31)),
    ]


def test_null_and_value_differ(people):
    merged = _merge(people, [(2, "Keila", "Bo")], "2025-06-01")
    assert merged.where("id = 2").count() == 2


def test_replace_member(people):
    moved = scd.scd2_replace_member(people, "id", 1, {"city": F.lit("Elva")}, "2025-02-01")
    assert _rows(moved.where("id = 1"), "city", "valid_from", "valid_to", "is_current") == [
        ("Elva", D(2025, 2, 1), D(9999, 12, 31), True),
        ("Tartu", D(2025, 1, 1), D(2025, 1, 31), False),
    ]
    assert moved.count() == 4


def test_overlap_is_found(spark):
    rows = [("a", D(2025, 1, 1), D(2025, 2, 1)), ("a", D(2025, 2, 1), D(9999, 12, 31))]
    assert scd.overlaps(spark.createDataFrame(rows, "k string, valid_from date, valid_to date"), "k").count() == 1


def test_previous_version(people):
    once = _merge(people, [(1, "Parnu", "Ann")], "2025-06-01")
    twice = _merge(once, [(1, "Elva", "Ann")], "2025-08-01")
    assert _rows(scd.previous_versions(twice, ["id"]), "id", "city") == [(1, "Parnu")]
    assert _rows(scd.version_counts(twice, ["id"]), "id", "version_count")[0] == (1, 3)


def test_dimension_keys_follow_the_business_key(spark):
    source = spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), ("c", 3)], "k string, v int")
    assert _rows(dims.build_dim(source, ["k"], ["v"]), "dim_key", "k", "v") == [(1, "a", 2), (2, "b", 1), (3, "c", 3)]


def test_conflicting_attributes(spark):
    source = spark.createDataFrame([("a", 2), ("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="more than one set"):
        dims.build_dim(source, ["k"], ["v"])
    assert _rows(dims.build_dim(source, ["k"], ["v"], keep="first"), "k", "v") == [("a", 1)]


def test_fixed_calendar(spark):
    calendar = dims.calendar_dim(dims.date_range(spark, "2025-01-01", "2026-12-31"))
    assert calendar.count() == 730
    first = calendar.orderBy("date_key").first()
    assert (first.date_key, first.day_name, first.month_name, first.iso_week, first.is_weekend) == (20250101, "Wednesday", "January", 1, False)


def test_time_dimension(spark):
    hours = {r.hour: r for r in dims.time_dim(spark).collect()}
    assert len(hours) == 24
    assert [hours[h].part_of_day for h in (4, 5, 9, 12, 15, 19, 23)] == ["small hours", "early", "forenoon", "midday", "late", "dusk", "small hours"]
    assert [h for h in hours if hours[h].is_business_hour] == list(range(7, 19))
    own = {r.hour: r for r in dims.time_dim(spark, bands=((6, "day"), (20, "night")), opens=9, closes=10).collect()}
    assert [own[h].part_of_day for h in (5, 6, 19, 20)] == ["night", "day", "day", "night"] and [h for h in own if own[h].is_business_hour] == [9]


def _all(df):
    return {tuple(r) for r in df.collect()}


def test_late_snapshots_in_any_order(spark):
    import itertools

    rows = [("a", D(2024, m, 1), p) for m, p in ((1, 1.0), (2, 1.0), (4, 3.0), (7, None), (8, 3.0))] + [("b", D(2024, 3, 1), 9.0), (None, D(2024, 2, 1), 5.0), (None, D(2024, 6, 1), 6.0)]
    schema = "k string, at date, price double"
    whole = spark.createDataFrame(rows, schema)
    want = _all(scd.scd2_from_snapshots(whole, "k", "at", ["price"]))
    loads = [rows[0::3], rows[1::3], rows[2::3]]
    for order in itertools.permutations(loads):
        dim = scd.scd2_from_snapshots(spark.createDataFrame(order[0], schema), "k", "at", ["price"])
        for load in (*order[1:], order[-1]):
            dim = scd.scd2_add_snapshots(dim, spark.createDataFrame(load, schema), "k", "at", ["price"])
        assert _all(dim) == want
    # a corrected snapshot of a known date replaces that version and leaves its dates
    fixed = scd.scd2_add_snapshots(scd.scd2_from_snapshots(whole, "k", "at", ["price"]), spark.createDataFrame([("a", D(2024, 4, 1), 30.0)], schema), "k", "at", ["price"])
    assert {(r.price, r.valid_from, r.valid_to) for r in fixed.where("k = 'a' AND price = 30").collect()} == {(30.0, D(2024, 4, 1), D(2024, 6, 30))}
    assert fixed.count() == len(rows)


def test_equal_neighbours_are_joined(spark):
    rows = [("a", D(2024, 1, 1), 1), ("a", D(2024, 2, 1), 1), ("a", D(2024, 3, 1), None), ("a", D(2024, 4, 1), None), ("a", D(2024, 5, 1), 1)]
    dim = scd.scd2_from_snapshots(spark.createDataFrame(rows, "k string, at date, x int"), "k", "at", ["x"])
    joined = scd.scd2_join_equal(dim, ["k"], ["x"])
    assert joined.columns == dim.columns
    assert [(r.x, r.valid_from, r.valid_to, r.is_current) for r in joined.orderBy("valid_from").collect()] == [
        (1, D(2024, 1, 1), D(2024, 2, 29), False), (None, D(2024, 3, 1), D(2024, 4, 30), False), (1, D(2024, 5, 1), D(9999, 12, 31), True)
    ]
    gap = joined.where("x IS NOT NULL")
    assert scd.scd2_join_equal(gap, ["k"], ["x"]).count() == 2  # days without a version lie between
