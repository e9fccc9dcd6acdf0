"""Text clean-up and key normalization as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: str | Column) -> Column:
    return F.nullif(F.trim(_col(col)), F.lit(""))


def normalized_key(col: str | Column) -> Column:
    """Trimmed lower-case text, for joins on e-mails and names."""
    return F.lower(F.trim(_col(col)))


def collapse_spaces(col: str | Column) -> Column:
    """Runs of white space become one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(_col(col), r"\s+", " "))


def safe_identifier(col: str | Column) -> Column:
    """Lower-case name holding only letters, digits and underscores."""
    return F.lower(F.regexp_replace(_col(col), "[^A-Za-z0-9]+", "_"))


def capitalize_words(col: str | Column) -> Column:
    """First letter of each word upper, the rest lower.

    A word starts after any character that is not a letter or digit, so
    `mary-ann o'neil` becomes `Mary-Ann O'Neil`; the built-in `initcap` only
    looks at white space.
    """
    text = F.lower(_col(col))
    pieces = F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substring(p, 2, 2147483646))), "")


def first_word(col: str | Column) -> Column:
    return F.split_part(_col(col), F.lit(" "), F.lit(1))


def after_first_word(col: str | Column) -> Column:
    """Everything behind the first space; empty when there is none."""
    parts = F.split(_col(col), " ", 2)
    return F.coalesce(F.try_element_at(parts, F.lit(2)), F.when(_col(col).isNotNull(), F.lit("")))


def short_code(col: str | Column, length: int = 8) -> Column:
    """Upper-case prefix of the MD5 of the text."""
    return F.upper(F.left(F.md5(_col(col)), F.lit(length)))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
