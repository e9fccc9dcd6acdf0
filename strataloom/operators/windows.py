"""Window operators that stay even when one key holds a third of all rows.

Top-n and latest-row use `row_number` with a bound, which Spark turns into a
group limit before the shuffle. Functions that need the whole group (lag, lead,
running sum, rank) always take one path: rows are dealt to ranges of key and
order, so that a long group, bursts included, lies over several ranges. The
work inside a range is an ordinary window, and one small row per (range, key)
carries the result of the ranges before. Running sums and ranks work on distinct
order values, so ties shrink before the shuffle.

The limits of the ranges are found once, from the key and order columns alone,
and stand in the plan as literals. The range of a row then follows from its
values: nothing is written aside, and what a lost executor held is worked out
again the same way.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.operators.joins import null_safe_on
from strataloom.session import cut_lineage

Order = Sequence[str | Column]
#: A column name (ascending, NULL first), or the name and how it is sorted: asc, asc_nulls_last or desc_nulls_last.
By = str | tuple[str, str]


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Order, n: int, rank_as: str | None = None) -> DataFrame:
    """The first n rows of each group; `order` must end with a tie break."""
    name = rank_as or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return ranked.withColumn(name, F.col(name).cast("bigint")) if rank_as else ranked.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key; also serves as latest row with a descending order."""
    return top_n_per_group(df, keys, order, 1)


def lag_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, alias: str, partitions: int | None = None) -> DataFrame:
    """`lag(value)` over keys and order; `order` must end with a tie break."""
    return _neighbour(df, keys, order, value, alias, partitions, back=True)


def lead_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, alias: str, partitions: int | None = None) -> DataFrame:
    """`lead(value)` over keys and order; `order` must end with a tie break."""
    return _neighbour(df, keys, order, value, alias, partitions, back=False)


def _sorting(by: Sequence[By]) -> list[tuple[str, str]]:
    return [(b, "asc") if isinstance(b, str) else b for b in by]


def range_limits(df: DataFrame, by: Sequence[By], partitions: int | None = None) -> list[list[str | None]]:
    """The first values of all ranges but the first, as texts; one row per range reaches the driver."""
    sorting = _sorting(by)
    order = [getattr(F.col(c), how)() for c, how in sorting]
    keys = df.select(*[c for c, _ in sorting])
    dealt = (keys.repartitionByRange(partitions, *order) if partitions else keys.repartitionByRange(*order)).withColumn("_range", F.spark_partition_id())
    first = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(*order))).where("_n = 1")
    rows = first.select("_range", *[F.col(c).cast("string").alias(c) for c, _ in sorting]).collect()
    return [list(r[1:]) for r in sorted(rows, key=lambda r: r[0])][1:]


def _before(a: Column, b: Column, how: str) -> Column:
    """Whether value a sorts before value b."""
    less = F.coalesce(a > b if how == "desc_nulls_last" else a < b, F.lit(False))
    return less | ((a.isNull() & b.isNotNull()) if how == "asc" else (a.isNotNull() & b.isNull()))


def range_of(df: DataFrame, by: Sequence[By], limits: Sequence[Sequence[str | None]]) -> Column:
    """Number of limits that do not sort behind the row: its range, by binary search in literal arrays."""
    if not limits:
        return F.lit(0)
    sorting, kinds = _sorting(by), dict(df.dtypes)
    columns = [F.from_json(F.lit(json.dumps([row[i] for row in limits])), "array<string>").cast(f"array<{kinds[c]}>") for i, (c, _) in enumerate(sorting)]

    def reached(i: Column) -> Column:
        found = F.lit(True)
        for (c, how), values in reversed(list(zip(sorting, columns, strict=True))):
            limit = F.get(values, i)
            found = _before(limit, F.col(c), how) | (limit.eqNullSafe(F.col(c)) & found)
        return found

    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(limits).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(limits)) & reached(at + step - 1), at + step).otherwise(at))


def ranged(df: DataFrame, by: Sequence[By], partitions: int | None = None) -> DataFrame:
    """`df` with the number of its range as `_part`; rows that are equal in `by` share a range."""
    return df.withColumn("_part", range_of(df, by, range_limits(df, by, partitions)))


def _neighbour(df, keys, order, value, alias, partitions, back: bool) -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    step, edge = (F.lag, F.max_by) if back else (F.lead, F.min_by)
    placed = ranged(df, [*keys, *order], partitions).withColumn("_value", v)
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    rows = placed.withColumn("_near", step("_value").over(inside)).withColumn("_edge", step(F.lit(True)).over(inside).isNull())
    # one row per key and range: the value that the next range of the key continues from
    across = Window.partitionBy(*keys).orderBy("_part")
    ends = placed.groupBy("_part", *keys).agg(edge(F.struct("_value"), F.struct(*order)).alias("_last"))
    carry = ends.select("_part", *keys, step("_last").over(across)["_value"].alias("_carry")).where("_carry IS NOT NULL")
    near = F.when(F.col("_edge"), F.col("_carry")).otherwise(F.col("_near"))
    joined = rows.join(carry, null_safe_on(rows, carry, ["_part", *keys]), "left")
    return joined.select(*[rows[c] for c in df.columns], near.alias(alias))


def _running(values: DataFrame, keys: Sequence[str], order: By, weight: str, alias: str, partitions: int | None) -> DataFrame:
    """Running sum of `weight` over rows that hold each (keys, order) once."""
    placed = ranged(values, [*keys, order], partitions)
    (name, how), *_ = _sorting([order])
    inside = Window.partitionBy("_part", *keys).orderBy(getattr(F.col(name), how)()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.withColumn("_inside", F.sum(weight).over(inside))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part", *keys).agg(F.sum(weight).alias("_sum"))
    carry = sums.select("_part", *keys, F.sum("_sum").over(before).alias("_before")).where("_before IS NOT NULL")
    running = F.when(F.col("_before").isNull(), F.col("_inside")).otherwise(F.col("_before") + F.coalesce(F.col("_inside"), F.lit(0)))
    joined = rows.join(carry, null_safe_on(rows, carry, ["_part", *keys]), "left")
    return joined.select(*[rows[c] for c in values.columns], running.alias(alias))


def running_sum_in_group(df: DataFrame, keys: Sequence[str], order: str, measure: str, alias: str, partitions: int | None = None) -> DataFrame:
    """Running sum over keys by order, equal order values taken together (the RANGE frame).

    The sums per order value are written once; the input is read for them and
    for the rows that they are joined to.
    """
    sums = cut_lineage(df.groupBy(*keys, order).agg(F.sum(measure).alias("_weight")))
    upto = _running(sums, keys, order, "_weight", alias, partitions).drop("_weight")
    return df.join(upto, null_safe_on(df, upto, [*keys, order])).select(df["*"], upto[alias])


def rank_in_group(
    df: DataFrame, keys: Sequence[str], measure: str, alias: str = "rank", descending: bool = True, dense: bool = False, partitions: int | None = None
) -> DataFrame:
    """RANK or DENSE_RANK of a measure within each group; NULL measures come last.

    Values are ordered as Spark sorts them: NaN is greater than any number.
    """
    counts = df.groupBy(*keys, measure).agg(F.count(F.lit(1)).alias("_n")).withColumn("_weight", F.lit(1) if dense else F.col("_n"))
    counts = cut_lineage(counts)
    summed = _running(counts, keys, (measure, "desc_nulls_last" if descending else "asc_nulls_last"), "_weight", "_upto", partitions)
    position = F.col("_upto") if dense else F.col("_upto") - F.col("_n") + 1
    ranks = summed.select(*keys, measure, position.cast("bigint").alias(alias))
    return df.join(ranks, null_safe_on(df, ranks, [*keys, measure]), "inner").select(df["*"], ranks[alias])


def running_sum_by_date(df: DataFrame, keys: Sequence[str], day: str, measure: str, alias: str) -> DataFrame:
    """Running sum for input already grouped to one row per key and date, so that
    a group is never longer than the calendar."""
    w = Window.partitionBy(*keys).orderBy(day).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(alias, F.sum(measure).over(w))


def global_row_number(df: DataFrame, order: Sequence[str], alias: str, partitions: int | None = None) -> DataFrame:
    """1..n in the order given, without bringing the rows into one task.

    Rows are range partitioned and numbered inside their partition; the row
    counts of the partitions before are then added. A row number as last range
    column lets many rows that are equal in the order spread over partitions.
    The sorted rows are written to the shared folder first, because a second
    evaluation could place the range limits elsewhere. The broadcast side has
    one row per partition.
    """
    by = [*order, "_tie"]
    df = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    numbered = cut_lineage(
        ranged.sortWithinPartitions(*by)
        .drop("_tie")
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_position", 33))
        .withColumn("_position", F.col("_position").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(alias, F.col("_before") + F.col("_position") + 1)
        .drop("_part", "_position", "_before")
    )
