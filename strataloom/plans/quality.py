"""Data quality: assertions, row rules with quarantine, profiles and registers.

An assertion is a table of failing rows; an empty table passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions.numbers import percent, round_half_up


@dataclass(frozen=True)
class Rule:
    """A named condition that is true for bad rows."""

    name: str
    fails: Column
    message: str
    value: Column


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; rows with a NULL key are ignored."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def out_of_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    return df.where(~F.col(column).between(lo, hi))


def row_count_verdict(df: DataFrame, lo: int, hi: int) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("row_count"), F.when(n.between(lo, hi), "pass").otherwise("fail").alias("status"))


def mark_duplicates(df: DataFrame, key: str | Column, flag: str, within: str | None = None) -> DataFrame:
    """Flag rows whose key occurs again elsewhere.

    The key may be an expression; it is then not carried along. Keys are counted with map-side partial counts and only repeated keys are
    joined back, so a key with very many copies is never gathered in one task
    to be counted.

    `within` names a column that is part of the key and that `df` is joined on
    next. The repeated keys are then gathered by it and met on it, so that both
    joins share one shuffle of `df`. Rows without a value there are not flagged.
    """
    key = F.col(key) if isinstance(key, str) else key
    counted = df.where(key.isNotNull()) if within is None else df.where(F.col(within).isNotNull())
    by = [key.alias("_key")] if within is None else [F.col(within).alias("_within"), key.alias("_key")]
    repeated = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if within is not None:
        gathered = repeated.groupBy("_within").agg(F.collect_list("_key").alias("_keys"))
        joined = df.join(gathered, F.col(within) == F.col("_within"), "left")
        return joined.withColumn(flag, F.coalesce(F.array_contains("_keys", key), F.lit(False))).drop("_within", "_keys")
    joined = df.join(repeated.select("_key"), key == F.col("_key"), "left")
    return joined.withColumn(flag, F.col("_key").isNotNull()).drop("_key")


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Test all rules in one pass: `failed` holds a flag per rule, `issue_count` their number, `rejected` whether any fails.

    Only flags are kept per row. Texts are made later and for failing rows alone.
    """
    flags = [F.coalesce(r.fails, F.lit(False)).alias(r.name) for r in rules]
    flagged = df.withColumn("failed", F.struct(*flags))
    count = sum((F.col("failed")[r.name].cast("int") for r in rules), F.lit(0))
    return flagged.withColumn("issue_count", count).withColumn("rejected", F.col("issue_count") > 0)


def stage_checked(checked: DataFrame, path: str) -> DataFrame:
    """Write checked rows once, clean and rejected ones in folders of their own, and read them again.

    Violations, summary, clean rows, quarantine and overview then cost a scan of
    the folder and the columns they need, and agree with one another.
    """
    checked.write.mode("overwrite").partitionBy("rejected").parquet(path)
    return checked.sparkSession.read.schema(checked.schema).parquet(path)


def violations(checked: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """One row per failed rule with its message and the value that failed."""
    issues = [
        F.struct(
            F.col("failed")[r.name].alias("_hit"),
            F.lit(r.name).alias("rule_name"),
            F.lit(r.message).alias("issue_message"),
            r.value.alias("failed_value"),
        )
        for r in rules
    ]
    rows = checked.where("rejected").select(*keep, F.inline(F.array(*issues)))
    return rows.where("_hit").drop("_hit")


def issue_summary(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failing rows per rule, counted from the flags; rules that never fail are left out."""
    counts = checked.where("rejected").agg(*[F.count_if(F.col("failed")[r.name]).alias(r.name) for r in rules])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule_name"), F.col(r.name).alias("failed_rows")) for r in rules])
    return counts.select(F.inline(pairs)).where("failed_rows > 0")


def clean_rows(checked: DataFrame) -> DataFrame:
    return checked.where("NOT rejected").drop("failed", "issue_count", "rejected")


def quarantine(checked: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Rejected rows with the ordered list of the rules they break."""
    names = [F.when(F.col("failed")[n], n) for n in sorted(r.name for r in rules)]
    return checked.where("rejected").select(*keep, F.array_join(F.array(*names), ", ").alias("failed_rules"))


def overview(checked: DataFrame) -> DataFrame:
    """Raw, clean and rejected rows, rule failures and reject percent, from one pass."""
    counts = checked.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~F.col("rejected")).alias("clean_rows"),
        F.count_if(F.col("rejected")).alias("rejected_rows"),
        F.coalesce(F.sum("issue_count"), F.lit(0)).cast("bigint").alias("rule_failures"),
    )
    return counts.withColumn("rejected_pct", percent("rejected_rows", "raw_rows", 2))


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls, distinct and unique share, min, max, mean and text length per column.

    Columns are turned into (column, value) pairs and counted per value first:
    repeated values shrink before the shuffle, and all statistics follow from
    the counts in the same job. Texts of any length are counted by their
    SHA-256, so that whole documents are not shuffled.
    """
    kinds = dict(df.dtypes)
    names = list(columns or df.columns)
    cells = []
    for c in names:
        numeric = kinds[c].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                _count_key(c, kinds[c]).alias("value"),
                (F.col(c).cast("double") if numeric else F.lit(None).cast("double")).alias("number"),
                (F.length(c).cast("bigint") if kinds[c] == "string" else F.lit(None).cast("bigint")).alias("text_length"),
            )
        )
    pairs = df.select(F.inline(F.array(*cells)))
    per_value = pairs.groupBy("column_name", "value", "number", "text_length").agg(F.count(F.lit(1)).alias("n"))
    set_n = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    stats = per_value.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        set_n.alias("value_count"),
        F.count("value").alias("distinct_count"),
        F.count_if(F.col("value").isNotNull() & (F.col("n") == 1)).alias("unique_count"),
        F.min("number").alias("min_number"),
        F.max("number").alias("max_number"),
        F.sum(F.col("number") * F.col("n")).alias("number_sum"),
        F.sum(F.when(F.col("number").isNotNull(), F.col("n"))).alias("number_n"),
        F.min("text_length").alias("min_length"),
        F.max("text_length").alias("max_length"),
        F.sum(F.col("text_length") * F.col("n")).alias("length_sum"),
        F.sum(F.when(F.col("text_length").isNotNull(), F.col("n"))).alias("length_n"),
    )
    return stats.select(
        "column_name",
        "row_count",
        "value_count",
        percent(F.col("row_count") - F.col("value_count"), "row_count", 2).alias("null_pct"),
        percent("distinct_count", "value_count", 2).alias("distinct_pct"),
        percent("unique_count", "value_count", 2).alias("unique_pct"),
        "min_number",
        "max_number",
        round_half_up(F.try_divide("number_sum", "number_n"), 4).alias("mean_number"),
        "min_length",
        "max_length",
        round_half_up(F.try_divide(F.col("length_sum").cast("double"), "length_n"), 4).alias("mean_length"),
    )


def _count_key(column: str, kind: str) -> Column:
    return F.sha2(column, 256) if kind == "string" else F.col(column).cast("string")


def load_verdict(df: DataFrame, column: str) -> DataFrame:
    """Row count, NULLs of a required column and OK or WARNING."""
    missing = F.count_if(F.col(column).isNull())
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        missing.alias("null_count"),
        F.when(missing == 0, "OK").otherwise("WARNING").alias("status"),
    )


def run_suite(checks: dict[str, DataFrame]) -> DataFrame:
    """Check name, status and failing rows for a set of assertions."""
    from strataloom.operators.aggregates import union_all

    n = F.count(F.lit(1))
    return union_all(
        [
            failing.agg(
                F.lit(name).alias("check_name"), F.when(n == 0, "pass").otherwise("fail").alias("status"), n.alias("failing_rows")
            )
            for name, failing in checks.items()
        ]
    )


def register_assets(registry: DataFrame, assets: DataFrame) -> DataFrame:
    """Upsert of asset descriptions by name."""
    from strataloom.plans.incremental import upsert

    return upsert(registry, assets, ["asset_name"])


def asset_rows(spark: SparkSession, assets: Sequence[dict]) -> DataFrame:
    fields = "asset_name string, asset_layer string, asset_type string, owner_name string, refresh_frequency string, source_system string, contains_personal_data boolean"
    names = [f.split()[0] for f in fields.split(", ")]
    return spark.createDataFrame([tuple(a[n] for n in names) for a in assets], fields)
