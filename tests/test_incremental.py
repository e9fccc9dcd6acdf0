import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from strataloom.operators.aggregates import same_rows
from strataloom.plans import incremental as inc
from strataloom.session import new_dir
from strataloom.sources import files, sinks

D = dt.date


def _set(df):
    return {tuple(r) for r in df.collect()}


def _local(path):
    return pathlib.Path(path.removeprefix("file:"))


def test_upsert_last_write_wins(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, at int")
    source = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 2)], "k int, v string, at int")
    got = inc.upsert(target, source, ["k"], latest_by=[F.desc("at")])
    assert _set(got) == {(1, "a", 1), (2, "d", 3), (3, "e", 2)}
    assert _set(inc.upsert(got, source, ["k"], latest_by=[F.desc("at")])) == _set(got)


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "z"), (2, "b")], "k int, v string")
    assert _set(inc.insert_if_absent(target, source, ["k"])) == {(1, "a"), (2, "b")}


def test_merge_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, name string, price int")
    updates = spark.createDataFrame([(2, None), (3, 9)], "k int, price int")
    assert _set(inc.merge_rows(target, updates, "k", ["price"])) == {(1, "a", 5), (2, "b", None), (3, None, 9)}


def test_repeated_source_keys_are_refused(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    for query in (lambda: inc.upsert(target, source, ["k"]), lambda: inc.merge_rows(target, source, "k", ["v"])):
        with pytest.raises(Exception, match="several source rows for one key"):
            query().collect()


def test_first_load_takes_all(spark):
    rows = spark.createDataFrame([(1, 1), (1, None), (2, 3)], "k int, at int")
    stats = [F.count("*").alias("n"), F.max("at").alias("last")]
    empty = rows.where("false").groupBy("k").agg(*stats)
    for mode in ("full_keys", "new_rows"):
        assert _set(inc.incremental_by_key(empty, rows, ["k"], "at", "last", stats, mode)) == {(1, 2, 1), (2, 1, 3)}
    daily = rows.where("false").groupBy("k", "at").agg(F.count("*").alias("n"))
    assert _set(inc.incremental_by_day(daily, rows, ["k"], "at", [F.count("*").alias("n")])) == {(1, 1, 1), (1, None, 1), (2, 3, 1)}


def test_whole_message_of_a_failed_run(spark):
    log = new_dir(spark, "faillog")
    with pytest.raises(Exception):
        inc.write_logged(spark.range(1).select(F.raise_error(F.lit("x" * 2000))), new_dir(spark, "fail"), log, "r", "s", D(2024, 1, 1))
    assert "x" * 2000 in spark.read.parquet(log).first().message


def test_null_condition_touches_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "k int, x int")
    assert _set(inc.delete_where(df, F.col("x") > 10)) == {(1, 5), (2, None)}
    assert _set(inc.update_where(df, F.col("x") > 10, {"x": F.lit(0)})) == {(1, 5), (2, None), (3, 0)}


def test_incremental_modes(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (1, 3)], "k int, at int")
    stats = [F.count("*").alias("n"), F.max("at").alias("last")]
    target = rows.where("at < 3").groupBy("k").agg(*stats)
    run = lambda mode: _set(inc.incremental_by_key(target, rows, ["k"], "at", "last", stats, mode))
    assert run("full_keys") == {(1, 3, 3), (2, 1, 1)}
    assert run("new_rows") == {(1, 1, 3), (2, 1, 1)}
    with pytest.raises(ValueError):
        run("other")


def test_late_rows_of_the_last_day(spark):
    rows = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 2)), (1, D(2024, 1, 2))], "k int, day date")
    stats = [F.count("*").alias("n")]
    target = spark.createDataFrame([(1, D(2024, 1, 1), 1), (1, D(2024, 1, 2), 1)], "k int, day date, n bigint")
    assert (1, D(2024, 1, 2), 2) in _set(inc.incremental_by_day(target, rows, ["k"], "day", stats))
    assert (1, D(2024, 1, 2), 1) in _set(inc.incremental_by_day(target, rows, ["k"], "day", stats, late_rows=False))


def test_first_gap(spark):
    log = spark.createDataFrame([(D(2026, 4, 1),), (D(2026, 4, 3),)], "d date")
    assert inc.first_missing_date(log, "d", "2026-04-01", "2026-04-04").first()[0] == D(2026, 4, 2)
    assert inc.first_missing_date(log, "d", "2026-04-03", "2026-04-03").first()[0] is None
    assert inc.missing_dates(log.where("d is null"), "d", "2026-04-01", "2026-04-02").count() == 2


@pytest.mark.parametrize("start, end", [(D(2026, 4, 3), D(2026, 4, 2)), (D(2026, 3, 1), D(2026, 4, 2)), (D(2026, 4, 1), D(2026, 6, 1))])
def test_date_range_is_refused(start, end):
    with pytest.raises(ValueError):
        inc.check_date_range(start, end, D(2026, 4, 1), D(2026, 5, 1))


def test_key_gate(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    assert inc.key_gate(rows, spark.createDataFrame([(1,), (2,)], "d int"), "k", "d").count() == 2
    with pytest.raises(ValueError, match="without a member"):
        inc.key_gate(rows, spark.createDataFrame([(1,)], "d int"), "k", "d")


def test_run_log_of_success_and_error(spark):
    log = new_dir(spark, "log")
    assert inc.write_logged(spark.range(7), new_dir(spark, "data"), log, "r", "good", D(2026, 4, 1)) == 7
    broken = spark.range(1).select(F.raise_error(F.lit("no source")).cast("string").alias("x"))
    with pytest.raises(Exception):
        inc.write_logged(broken, new_dir(spark, "data"), log, "r", "bad", D(2026, 4, 1))
    got = {(r.step_name, r.status, r.rows_loaded) for r in spark.read.parquet(log).collect()}
    assert got == {("good", "success", 7), ("bad", "error", 0)}


def test_change_log_as_of(spark):
    log = spark.createDataFrame([(1, 1, "insert", "a"), (1, 2, "update", "b"), (2, 1, "insert", "c"), (2, 3, "delete", None)], "k int, v int, op string, x string")
    at = lambda v: {(r.k, r.x) for r in inc.read_as_of(log, ["k"], "v", v, "op", []).collect()}
    assert at(1) == {(1, "a"), (2, "c")}
    assert at(2) == {(1, "b"), (2, "c")}
    assert at(3) == {(1, "b")}


def test_partition_replace_keeps_the_others(spark):
    path = new_dir(spark, "parts")
    sinks.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, ["p"])
    for _ in range(2):
        sinks.replace_partitions(spark.createDataFrame([(9, "b")], "x int, p string"), path, ["p"])
    assert {(r.x, r.p) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}


def test_partition_folders_are_few_and_pruned(spark, plan_of):
    path = new_dir(spark, "pruned")
    rows = spark.range(4000).repartition(8).select("id", F.pmod("id", F.lit(5)).alias("p"))
    sinks.write_partitioned(rows, path, ["p"])
    layout = sinks.partition_layout(spark.read.parquet(path), ["p"]).collect()
    assert sum(r.row_count for r in layout) == 4000 and all(r.file_count == 1 and r.bytes > 0 for r in layout)
    plan = plan_of(spark.read.parquet(path).where("p = 3"))
    assert "PartitionFilters: [isnotnull(p" in plan and "(p#" in plan


def test_compaction_keeps_rows(spark):
    small, large = new_dir(spark, "small"), new_dir(spark, "large")
    spark.range(1000).repartition(20).write.parquet(small)
    sinks.compact(spark, small, large)
    assert len(list(_local(small).glob("*.parquet"))) == 20 and len(list(_local(large).glob("*.parquet"))) == 1
    assert same_rows(spark.read.parquet(small), spark.read.parquet(large)).count() == 0


def test_json_array_file_and_nested_fields(spark):
    path = new_dir(spark, "json") + ".json"
    _local(path).write_text(json.dumps([{"id": 1, "address": {"city": "Tartu"}}, {"id": 2, "address": {"city": "Õismäe"}}]))
    df = files.flatten(files.read_json(spark, path, multi_line=True), {"id": "id", "city": "address.city"})
    assert _set(df) == {(1, "Tartu"), (2, "Õismäe")}


def test_first_element_and_key_with_default(spark):
    df = spark.createDataFrame([(["a", "b"], {"EUR": 1}), ([], {}), (None, None)], "xs array<string>, m map<string,int>")
    got = [tuple(r) for r in df.select(files.first_element("xs", "-"), files.first_map_key("m", "?")).collect()]
    assert got == [("a", "EUR"), ("-", "?"), ("-", "?")]


def test_parallel_arrays(spark):
    df = spark.createDataFrame([("x", ["d1", "d2"], [1.0, None])], "k string, days array<string>, temps array<double>")
    assert _set(files.arrays_to_rows(df, {"day": "days", "temp": "temps"}, ["k"])) == {("x", "d1", 1.0), ("x", "d2", None)}


def test_bad_csv_fails(spark):
    path = new_dir(spark, "csv")
    spark.createDataFrame([("1",), ("x",)], "a string").coalesce(1).write.option("header", True).csv(path)
    with pytest.raises(Exception):
        files.read_csv(spark, path, "a int").collect()


def test_shared_folder_is_taken_from_the_session(spark):
    root = spark.sparkContext.getCheckpointDir()
    assert root and not new_dir(spark, "x") == new_dir(spark, "x")


class _Session:
    """The few parts of a session that decide where tables are written."""

    def __init__(self, setting, master):
        self.conf = self.sparkContext = self
        self.setting, self.master, self.folder = setting, master, None

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_configured_folder_is_used():
    session = _Session("hdfs://shared/checkpoints", "spark://m:7077")
    assert new_dir(session, "x").startswith("hdfs://shared/checkpoints/x-")
    assert session.folder == "hdfs://shared/checkpoints"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_dir(_Session(None, "spark://m:7077"), "x")


def test_preview_and_schema_of_a_source(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert files.preview(df, 1).count() == 1
    assert {tuple(r) for r in files.schema_rows(df).collect()} == {(1, "n", "int", 2), (2, "s", "string", 2)}


def test_period_comes_from_the_file_name(spark):
    root = new_dir(spark, "periods")
    for month in ("2026_03", "2026_04"):
        spark.range(3).write.parquet(f"{root}/products_{month}")
    paths = [f"{root}/products_{m}" for m in ("2026_03", "2026_04")]
    loaded = files.read_period_files(spark, paths, r"products_(\d{4}_\d{2})", "period")
    assert {(r.period, r["count"]) for r in loaded.groupBy("period").count().collect()} == {("2026_03", 3), ("2026_04", 3)}
