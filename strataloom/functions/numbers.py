"""Exact arithmetic for money, shares and averages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
AMOUNT = "decimal(18,4)"


def money(col: str | Column) -> Column:
    """Two-place decimal, so that sums do not depend on the order of addition."""
    return _col(col).cast(MONEY)


def net_price(price: str | Column, discount: str | Column) -> Column:
    """price x (1 - discount)."""
    return _col(price) * (F.lit(1) - _col(discount))


def net_amount(price: str | Column, discount: str | Column) -> Column:
    """price x (1 - discount) as a four-place decimal."""
    return net_price(price, discount).cast(AMOUNT)


def exact_sum(col: str | Column, places: int = 2) -> Column:
    """Sum of values with at most `places` decimals, free of rounding errors.

    Values are added as whole units (cents), which is much cheaper than turning
    every double into a decimal; the decimal sum cannot overflow. A value with
    more decimals, NaN or one beyond the units of a bigint is refused.
    """
    return F.sum(_units(col, places)) * _unit(places)


def total(col: str | Column, places: int = 2) -> Column:
    """Exact sum, returned as double."""
    return exact_sum(col, places).cast("double")


def mean(col: str | Column, places: int = 2) -> Column:
    """Rounded average of a money column."""
    return F.round(F.avg(_units(col, 2)) * _unit(2), places).cast("double")


def mean_of_sums(units: str | Column, count: str | Column, places: int = 2) -> Column:
    """Rounded average from partial exact sums (money) and counts."""
    return F.round((F.sum(units).cast("decimal(34,6)") / F.sum(count).cast("decimal(18,0)")).cast("decimal(28,6)"), places).cast("double")


def tidy(col: str | Column, places: int) -> Column:
    """Double with its floating-point noise removed, for values that have at most `places` decimals."""
    return F.floor(_col(col) * float(10**places) + 0.5) / F.lit(float(10**places))


def _units(col: str | Column, places: int) -> Column:
    """Whole units of 10^-places; a value that is none (more decimals, NaN, too large) fails the query."""
    scaled = _col(col) * float(10**places)
    whole = F.floor(scaled + 0.5)
    off = ~(F.abs(scaled - whole) <= 0.01)
    refuse = F.raise_error(F.concat(F.lit(f"not a whole number of units of 1e-{places}: "), _col(col).cast("string")))
    return F.when(off, refuse.cast("decimal(19,0)")).otherwise(whole.cast("decimal(19,0)"))


def _unit(places: int) -> Column:
    return F.lit(Decimal(1).scaleb(-places))


def round_half_up(col: str | Column, places: int) -> Column:
    """Round a double through decimal, so that printed ties always go up."""
    return F.round(_col(col).cast("decimal(28,8)"), places).cast("double")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; NULL where den is zero or NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def percent(part: str | Column, whole: str | Column, places: int = 1) -> Column:
    return round_half_up(F.lit(100.0) * safe_ratio(part, whole), places)


def floor_to(col: str | Column, step: int) -> Column:
    """Largest multiple of `step` not above the value."""
    return (F.floor(_col(col) / F.lit(float(step))) * F.lit(step)).cast("int")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
