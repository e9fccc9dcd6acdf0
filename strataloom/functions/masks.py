"""Column masks: the shapes that restricted readers see instead of raw values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.functions.dates import month_start
from strataloom.functions.numbers import floor_to


def mask_text(col: str | Column) -> Column:
    """First letter kept, every other character a star."""
    c = _col(col)
    return F.concat(F.left(c, F.lit(1)), F.repeat(F.lit("*"), F.greatest(F.length(c) - 1, F.lit(0))))


def mask_email(col: str | Column) -> Column:
    """First letter and domain kept; `***` where there is nothing before the @."""
    c = _col(col)
    shown = F.concat(F.left(c, F.lit(1)), F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(2)))
    return F.when(F.position(F.lit("@"), c) > 1, shown).otherwise("***")


def mask_email_plain(col: str | Column) -> Column:
    """The unguarded form: NULL stays NULL, a text without @ gives an empty domain."""
    c = _col(col)
    return F.concat(F.left(c, F.lit(1)), F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(2)))


def mask_phone(col: str | Column) -> Column:
    c = _col(col)
    return F.concat(F.left(c, F.lit(4)), F.lit(" *** "), F.right(c, F.lit(2)))


def mask_date(col: str | Column) -> Column:
    return month_start(_col(col))


def mask_int(col: str | Column) -> Column:
    return floor_to(_col(col), 1000)


def mask_null(col: str | Column, data_type: str = "string") -> Column:
    return F.lit(None).cast(data_type)


def mask_redacted(col: str | Column) -> Column:
    return F.lit("REDACTED")


def keep(col: str | Column) -> Column:
    return _col(col)


MASKS: dict[str, Callable[[str | Column], Column]] = {
    "keep": keep,
    "text": mask_text,
    "email": mask_email,
    "email_plain": mask_email_plain,
    "phone": mask_phone,
    "date": mask_date,
    "int": mask_int,
    "null": mask_null,
    "redacted": mask_redacted,
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
