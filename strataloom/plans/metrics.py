"""Named metrics over a star: one definition, any slice, any level."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.numbers import round_half_up


@dataclass(frozen=True)
class Metric:
    """An aggregate of a value, over the rows that belong to its definition.

    Value and condition are SQL expressions over the columns of the facts.
    `combine` puts results of smaller groups together into those of larger ones.
    """

    name: str
    aggregate: Callable[[Column], Column]
    value: str
    where: str | None = None
    combine: Callable[[Column], Column] = F.sum
    result: str | None = None

    @property
    def parts(self) -> tuple[Metric, ...]:
        return (self,)

    def partial(self) -> Column:
        value = F.expr(self.value)
        return self.aggregate(value if self.where is None else F.when(F.expr(self.where), value)).alias(self.name)

    def final(self) -> Column:
        column = F.col(self.name)
        return (column.cast(self.result) if self.result else column).alias(self.name)


@dataclass(frozen=True)
class Ratio:
    """A metric divided by another one; NULL where the divisor is zero."""

    name: str
    numerator: Metric
    denominator: Metric
    places: int = 2

    @property
    def parts(self) -> tuple[Metric, ...]:
        return (self.numerator, self.denominator)

    def final(self) -> Column:
        quotient = F.try_divide(F.col(self.numerator.name).cast("double"), F.col(self.denominator.name).cast("double"))
        return round_half_up(quotient, self.places).alias(self.name)


def _parts(metrics: Sequence[Metric | Ratio]) -> list[Metric]:
    """The plain metrics that the wanted ones need, each once."""
    return list({p.name: p for m in metrics for p in m.parts}.values())


def measure(facts: DataFrame, metrics: Sequence[Metric | Ratio], grain: Sequence[str], filters: Sequence[Column] = ()) -> DataFrame:
    """Metrics per grain over the rows that pass the slice filters, in one pass."""
    for f in filters:
        facts = facts.where(f)
    return facts.groupBy(*grain).agg(*[p.partial() for p in _parts(metrics)]).select(*grain, *[m.final() for m in metrics])


def drill_down(facts: DataFrame, metrics: Sequence[Metric | Ratio], levels: Sequence[str]) -> DataFrame:
    """All levels of a hierarchy at once, from the grand total (level 0) to the last level.

    The facts are grouped to the last level first. Only those groups are rolled
    up, so the facts themselves are not repeated once per level.
    """
    parts = _parts(metrics)
    lowest = facts.groupBy(*levels).agg(*[p.partial() for p in parts])
    depth = sum((F.lit(1) - F.grouping(c) for c in levels), F.lit(0)).cast("bigint").alias("level_no")
    rolled = lowest.rollup(*levels).agg(depth, *[p.combine(F.col(p.name)).alias(p.name) for p in parts])
    return rolled.select(*levels, "level_no", *[m.final() for m in metrics])
