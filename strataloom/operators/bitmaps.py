"""Distinct counts that can be added up: bitmaps per group, kept and united later.

An id is a bit in the bitmap of its bucket of 32,768 ids; a stored row is
(group, bucket, bits) with bits of at most 4 KB. Uniting the rows of several
groups and counting bits gives COUNT(DISTINCT) of all of them, exactly, without
reading the ids again. It suits dense whole-number ids, where a bucket holds
many of them; for sparse ones a bucket is a row with few bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STORED = ["bucket", "bits"]


def id_bitmaps(rows: DataFrame, groups: Sequence[str | Column], id_: str) -> DataFrame:
    """groups, bucket, bits; rows with a NULL id leave no bit."""
    named = rows.where(F.col(id_).isNotNull())
    return named.groupBy(*groups, F.bitmap_bucket_number(id_).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("bits"))


def united(bitmaps: DataFrame, groups: Sequence[str | Column] = ()) -> DataFrame:
    """Bitmaps of larger groups, from those of the groups in them."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(bitmaps: DataFrame, groups: Sequence[str] = (), alias: str = "distinct_count") -> DataFrame:
    """Exact number of different ids of each group; bitmaps of one group and bucket are united first."""
    return united(bitmaps, groups).groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(alias))


def trailing_distinct(bitmaps: DataFrame, day: str, days: int, alias: str = "distinct_count") -> DataFrame:
    """Per day that occurs: different ids of it and the `days - 1` days before.

    A stored bitmap goes to each of the days it counts for, so what is shuffled
    is `days` times the bitmaps, however many rows a day has.
    """
    known = bitmaps.select(F.col(day).alias("_known")).distinct()
    spread = bitmaps.select(F.explode(F.sequence(F.col(day), F.date_add(F.col(day), days - 1))).alias(day), *STORED)
    return distinct_count(spread.join(known, F.col(day) == F.col("_known"), "left_semi"), [day], alias)
