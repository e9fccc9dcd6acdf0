"""Tables by day: replaced in one step or not at all."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataloom.plans import incremental as inc
from strataloom.session import new_dir
from strataloom.sources import versioned
from strataloom.sources.versioned import DayTable, replace_days

D = dt.date


@pytest.fixture
def table(spark):
    rows = spark.createDataFrame([(D(2024, 1, d), d) for d in (1, 2, 3)] + [(None, 0)], "day date, n int")
    made = DayTable(spark, new_dir(spark, "days"), "day", rows.schema)
    assert made.read().count() == 0 and made.last()[0] == 0
    made.replace(rows)
    return made


def numbers(df):
    return sorted(r.n for r in df.collect())


def rows_of(table, *rows):
    return table.spark.createDataFrame(list(rows), table.schema)


def test_days_are_replaced_and_emptied(table):
    replace_days(table, rows_of(table, (D(2024, 1, 1), 10), (D(2024, 1, 9), 90)), D(2024, 1, 1), D(2024, 1, 2))
    assert numbers(table.read()) == [0, 3, 10]
    assert numbers(table.read([D(2024, 1, 1), None])) == [0, 10] and numbers(table.read(number=1)) == [0, 1, 2, 3]
    table.replace(rows_of(table), [D(2024, 1, 3)])
    assert numbers(table.read()) == [0, 10]
    with pytest.raises(ValueError, match="outside"):
        table.replace(rows_of(table, (D(2024, 1, 9), 9)), [D(2024, 1, 3)])
    assert numbers(table.read()) == [0, 10]


def test_a_failing_write_leaves_the_old_days(table):
    fails = F.when(F.col("n") == 7, F.raise_error(F.lit("disk gone")).cast("int")).otherwise(F.col("n"))
    bad = rows_of(table, *[(D(2024, 1, 1 + i % 3), i) for i in range(10)]).repartition(4).withColumn("n", fails)
    with pytest.raises(Exception, match="disk gone"):
        replace_days(table, bad, D(2024, 1, 1), D(2024, 1, 3))
    assert numbers(table.read()) == [0, 1, 2, 3] and table.last()[0] == 1
    replace_days(table, rows_of(table, (D(2024, 1, 2), 5)), D(2024, 1, 1), D(2024, 1, 3))
    assert numbers(table.read()) == [0, 5]


def test_a_broken_step_between_writing_and_naming_changes_nothing(table, monkeypatch):
    def broken(self, number, content):
        raise OSError("gone before the list was named")

    monkeypatch.setattr(DayTable, "_publish", broken)
    with pytest.raises(OSError):
        table.replace(rows_of(table, (D(2024, 1, 1), 99)))
    monkeypatch.undo()
    assert numbers(table.read()) == [0, 1, 2, 3]
    assert table.vacuum() == 1 and numbers(table.read()) == [0, 1, 2, 3]


def test_a_table_may_be_rewritten_from_itself(table):
    replace_days(table, table.read().withColumn("n", F.col("n") + 100), D(2024, 1, 1), D(2024, 1, 2))
    assert numbers(table.read()) == [0, 3, 101, 102]
    assert table.vacuum(keep=2) == 0 and table.vacuum() == 2
    assert numbers(table.read()) == [0, 3, 101, 102] and table.last()[0] == 2


def test_two_writers(table):
    other = DayTable(table.spark, table.path, "day", table.schema)
    number = table.last()[0]
    other.replace(rows_of(table, (D(2024, 1, 1), 11)))
    with pytest.raises(versioned.Changed):
        table.replace(rows_of(table, (D(2024, 1, 1), 12)), after=number)
    with pytest.raises(versioned.Changed):
        table._publish(other.last()[0], {"folders": [], "marks": {}})
    assert numbers(table.read()) == [0, 2, 3, 11]


def test_marks_stay(table):
    table.replace(rows_of(table), [], marks={"stream": 4})
    table.replace(rows_of(table, (D(2024, 1, 1), 1)), marks={"other": 1})
    assert (table.mark("stream"), table.mark("other"), table.mark("none")) == (4, 1, None)


def test_only_wanted_days_are_read(table, plan_of):
    assert len(table.read([D(2024, 1, 2)]).inputFiles()) == 1
    with pytest.raises(ValueError, match="commit_id"):
        DayTable(table.spark, table.path, "day", table.schema.add("commit_id", "string"))


def test_backfill(spark, table):
    source = rows_of(table, *[(D(2024, 1, d), d * 10) for d in (1, 3)])
    for _ in range(2):
        inc.backfill(source, table, D(2024, 1, 1), D(2024, 1, 3))
        assert numbers(table.read()) == [0, 10, 30]
    with pytest.raises(ValueError, match="no rows"):
        inc.backfill(source.where("false"), table, D(2024, 1, 1), D(2024, 1, 3))
    with pytest.raises(ValueError, match="outside"):
        inc.backfill(source, table, D(2024, 1, 1), D(2024, 1, 9))
