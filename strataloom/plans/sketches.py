"""Column profiles that can be added up: one stored row per part of a table and column.

A stored row holds exact counts, sums and ends, and two sketches: HLL for
different values and KLL for quantiles. Merging the rows of parts gives the
profile of their union, so a new day is profiled alone and merged with what is
stored. Sketches have a bounded size and a known error; the exact profile of
`plans.quality` remains for tables that fit it.

Whole numbers and decimals are added up and compared as decimals, dates and
times as themselves, without a detour over double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.numbers import percent

LG_HLL = 14  # 2^14 registers: a standard error of some 0.8 %
KLL_K = 400  # rank error of some 0.7 %
EXACT = "decimal(38,10)"


def _kind(dtype: str) -> str:
    name = dtype.split("(")[0]
    if name in ("tinyint", "smallint", "int", "bigint", "decimal"):
        return "whole"
    if name in ("float", "double"):
        return "double"
    if name in ("date", "timestamp", "timestamp_ntz"):
        return "time"
    return "other"


def profile_parts(df: DataFrame, parts: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """One row per part and column, to be stored.

    All columns are worked on in one pass, as pairs (column, value) reduced on
    the map side; only counts, ends and sketches are shuffled.
    """
    kinds = {c: _kind(t) for c, t in df.dtypes}
    names = {c: f"_part_{i}" for i, c in enumerate(parts)}
    cells = []
    for c in columns:
        kind, value = kinds[c], F.col(c)
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                value.cast("string").alias("_text"),
                (value.cast(EXACT) if kind == "whole" else F.lit(None).cast(EXACT)).alias("_exact"),
                (value.cast("double") if kind in ("whole", "double") else F.lit(None).cast("double")).alias("_number"),
                (value.cast("timestamp") if kind == "time" else F.lit(None).cast("timestamp")).alias("_time"),
            )
        )
    keys = [F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for c, n in names.items()]
    pairs = df.select(*keys, F.inline(F.array(*cells)))
    found = pairs.groupBy(*names.values(), "column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("_text").alias("value_count"),
        F.hll_sketch_agg("_text", F.lit(LG_HLL)).alias("values"),
        F.kll_sketch_agg_double("_number", F.lit(KLL_K)).alias("ranks"),
        F.min("_exact").alias("min_exact"),
        F.max("_exact").alias("max_exact"),
        F.sum("_exact").alias("sum_exact"),
        F.min("_number").alias("min_number"),
        F.max("_number").alias("max_number"),
        F.min("_time").alias("min_time"),
        F.max("_time").alias("max_time"),
        F.min(F.length("_text")).alias("min_length"),
        F.max(F.length("_text")).alias("max_length"),
    )
    return found.withColumnsRenamed({n: c for c, n in names.items() if isinstance(c, str)})


def merge_parts(stored: DataFrame, parts: Sequence[str | Column] = ()) -> DataFrame:
    """Stored rows of larger parts, from those of the parts in them; without `parts`, of the whole table."""
    ends = [c for c in stored.columns if c.startswith(("min_", "max_"))]
    return stored.groupBy(*parts, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("value_count").alias("value_count"),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("ranks", F.lit(KLL_K)).alias("ranks"),
        F.sum("sum_exact").cast(EXACT).alias("sum_exact"),
        *[(F.min if c.startswith("min_") else F.max)(c).alias(c) for c in ends],
    )


def read_profile(stored: DataFrame, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Shares, ends, mean, approximate distinct count and quantiles of stored rows, beside their part.

    Ends are typed: min_exact of whole numbers and decimals, min_number of all
    numbers, min_time of dates and times; the mean is of whole numbers and
    decimals.
    """
    parts = stored.columns[: stored.columns.index("column_name") + 1]
    has_numbers = F.kll_sketch_get_n_double("ranks") > 0
    return stored.select(
        *parts,
        "row_count",
        "value_count",
        percent(F.col("row_count") - F.col("value_count"), "row_count", 2).alias("null_pct"),
        F.hll_sketch_estimate("values").alias("distinct_about"),
        *[c for c in stored.columns if c.startswith(("min_", "max_"))],
        F.round(F.try_divide("sum_exact", "value_count"), 4).cast("double").alias("mean_exact"),
        *[F.when(has_numbers, F.kll_sketch_get_quantile_double("ranks", F.lit(float(q)))).alias(f"q{round(q * 100)}") for q in quantiles],
    )
