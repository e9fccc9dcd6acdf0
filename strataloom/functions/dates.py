"""Calendar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end of an open validity range.
OPEN_END = "9999-12-31"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def date_key(col: str | Column) -> Column:
    """YYYYMMDD as an integer."""
    c = _col(col)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_start(col: str | Column) -> Column:
    return F.trunc(_col(col), "MM")


def iso_weekday(col: str | Column) -> Column:
    """Monday 1 to Sunday 7."""
    return (F.weekday(_col(col)) + 1).cast("int")


def day_name(col: str | Column) -> Column:
    return F.date_format(_col(col), "EEEE")


def month_name(col: str | Column) -> Column:
    return F.date_format(_col(col), "MMMM")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end; works with and without a time zone."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))).cast("bigint")


def days(lo: str | Column, hi: str | Column, step: int = 1) -> Column:
    """Array of the dates from lo to hi, both included."""
    return F.sequence(_col(lo), _col(hi), F.make_dt_interval(F.lit(step)))


#: First hour and name of each part of the day; hours before the first belong to the last.
DAY_BANDS = ((0, "small hours"), (5, "early"), (9, "forenoon"), (12, "midday"), (15, "late"), (19, "dusk"), (23, "small hours"))


def part_of_day(hour: str | Column, bands: Sequence[tuple[int, str]] = DAY_BANDS) -> Column:
    name = F.lit(bands[-1][1])
    for first, label in sorted(bands):
        name = F.when(_col(hour) >= first, label).otherwise(name)
    return name


def is_business_hour(hour: str | Column, opens: int = 7, closes: int = 19) -> Column:
    return (_col(hour) >= opens) & (_col(hour) < closes)


def parse_iso(col: str | Column) -> Column:
    """ISO text with or without a zone, as an instant; NULL when unreadable."""
    return F.try_to_timestamp(_col(col))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
