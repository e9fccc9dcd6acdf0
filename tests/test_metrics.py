from pyspark.sql import functions as F

from strataloom.plans.metrics import Metric, Ratio, drill_down, measure

SALES = Metric("sales", F.sum, "amount")
ROWS = Metric("row_count", F.count, "id")
BIG = Metric("big", F.count, "id", where="amount > 5")
TOP = Metric("top", F.max, "amount", combine=F.max)
AVERAGE = Ratio("average", SALES, ROWS)


def _facts(spark):
    rows = [(1, "a", "x", 2), (2, "a", "y", 10), (3, "b", "x", 6), (4, "b", None, 1)]
    return spark.createDataFrame(rows, "id int, region string, city string, amount int")


def test_conditions_belong_to_their_metric(spark):
    got = {tuple(r) for r in measure(_facts(spark), [SALES, BIG, AVERAGE], ["region"]).collect()}
    assert got == {("a", 12, 1, 6.0), ("b", 7, 1, 3.5)}


def test_slice(spark):
    got = [tuple(r) for r in measure(_facts(spark), [SALES], ["city"], [F.col("region") == "a", F.col("amount") > 5]).collect()]
    assert got == [("y", 10)]


def test_levels_agree_with_their_groups(spark):
    facts = _facts(spark)
    levels = drill_down(facts, [SALES, ROWS, TOP, AVERAGE], ["region", "city"])
    by_level = {n: {(r.region, r.city): (r.sales, r.row_count, r.top, r.average) for r in levels.where(F.col("level_no") == n).collect()} for n in (0, 1, 2)}
    assert by_level[0] == {(None, None): (19, 4, 10, 4.75)}
    assert by_level[1] == {("a", None): (12, 2, 10, 6.0), ("b", None): (7, 2, 6, 3.5)}
    assert by_level[2][("b", None)] == (1, 1, 1, 1.0) and len(by_level[2]) == 4


def test_empty_input_gives_no_ratio(spark):
    assert measure(_facts(spark).where("id > 9"), [AVERAGE], []).first()[0] is None
