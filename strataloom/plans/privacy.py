"""What each reader sees: masked columns, filtered rows, groups, and who read what."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.masks import MASKS
from strataloom.session import cut_lineage

# A reader with several roles gets the view of the first one here.
ROLE_ORDER = ("auditor", "analyst", "marketing")


def effective_role(roles: Sequence[str], order: Sequence[str] = ROLE_ORDER) -> str | None:
    return next((r for r in order if r in roles), None)


def secure_view(df: DataFrame, policy: Mapping[str, Mapping[str, str]], roles: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project each column through the mask of the reader's strongest role.

    `policy` maps a column to {role: mask}; the entry `other` serves roles that
    are not listed. Columns named in `keep` are shown as they are; a column that
    has neither is refused, so that a new one never shows by oversight. A NULL
    keeps the type of its column.
    """
    if (open_ := [c for c in df.columns if c not in policy and c not in keep]):
        raise ValueError(f"column {open_[0]!r} has no policy")
    role = effective_role(roles)
    types = dict(df.dtypes)

    def shown(c: str) -> Column:
        if c not in policy:
            return F.col(c)
        mask = policy[c].get(role, policy[c].get("other", "null")) if role else policy[c].get("other", "null")
        return (F.lit(None).cast(types[c]) if mask == "null" else MASKS[mask](c)).alias(c)

    return df.select(*[shown(c) for c in df.columns])


def region_rows(df: DataFrame, column: str, region: str | None) -> DataFrame:
    """Rows of the reader's region; none while no region is set."""
    return df.where(F.lit(False)) if region is None else df.where(F.col(column) == region)


def allowed_columns(df: DataFrame, granted: Sequence[str], wanted: Sequence[str] | None = None) -> DataFrame:
    """The wanted columns, provided that every one of them is granted."""
    wanted = list(granted) if wanted is None else list(wanted)
    if (denied := [c for c in wanted if c not in granted]):
        raise PermissionError(f"permission denied for column {denied[0]!r}")
    return df.select(*wanted)


def regional_view(df: DataFrame, column: str, region: str | None, granted: Sequence[str], wanted: Sequence[str] | None = None) -> DataFrame:
    """Row filter and column list together."""
    return allowed_columns(region_rows(df, column, region), granted, wanted)


def small_groups(df: DataFrame, keys: Sequence[str], k: int = 3) -> DataFrame:
    """Groups with fewer than k rows, in which people could be recognized."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") < k)


def suppressed_counts(df: DataFrame, keys: Sequence[str], k: int = 3) -> DataFrame:
    """Group counts where small ones are shown as NULL."""
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(F.when(n >= k, n).alias("row_count"))


def mask_by_register(df: DataFrame, register: Mapping[str, str], handling: Mapping[str, str]) -> DataFrame:
    """Mask each column as its category in the register asks.

    `register` maps columns to categories and `handling` maps columns, or else
    categories, to masks. A column missing from the register is left out.
    """
    def mask_of(c: str) -> str:
        return handling.get(c, handling.get(register[c], "keep"))

    types = dict(df.dtypes)
    known = [c for c in df.columns if c in register]
    return df.select(*[(F.lit(None).cast(types[c]) if mask_of(c) == "null" else MASKS[mask_of(c)](c)).alias(c) for c in known])


def privilege_matrix(grants: DataFrame, role: str = "role_name", item: str = "object_name", buckets: int = 8) -> DataFrame:
    """Every role and object of a grant list with whether the grant exists.

    The grants are worked out once. Every role meets every object, bucket by
    bucket of the objects, so neither list is gathered in a row or a task.
    """
    held = cut_lineage(grants.select(role, item).distinct())
    number = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    roles = held.select(role).distinct().withColumn("_bucket", number)
    items = held.select(item).distinct().withColumn("_bucket", F.pmod(F.xxhash64(item), F.lit(buckets)).cast("int"))
    pairs = roles.join(items, "_bucket").select(role, item)
    return pairs.join(held.withColumn("can_select", F.lit(True)), [role, item], "left").withColumn("can_select", F.coalesce("can_select", F.lit(False)))


def forbidden_grants(grants: DataFrame, forbidden: Column) -> DataFrame:
    """Grants that must not exist; empty means pass."""
    return grants.where(forbidden)


# Fixed value: shape of one audit line. The statement may be quoted and hold commas.
AUDIT_LINE = r'AUDIT: ([A-Z]+),(\d+),(\d+),([A-Z]*),([A-Z ]*),([A-Z ]*),([^,]*),("(?:[^"]|"")*"|[^,]*),(.*)$'
AUDIT_FIELDS = ("audit_type", "statement_id", "substatement_id", "class", "command", "object_type", "object_name", "statement", "parameter")


def parse_audit(lines: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Fields of the audit lines among log lines; doubled quotes are undone."""
    c = F.col(column)
    fields = {n: F.regexp_extract(c, AUDIT_LINE, i) for i, n in enumerate(AUDIT_FIELDS, 1)}
    bare = F.regexp_replace(F.regexp_replace(fields["statement"], '^"|"$', ""), '""', '"')
    typed = {
        **fields,
        "statement_id": fields["statement_id"].cast("bigint"),
        "substatement_id": fields["substatement_id"].cast("bigint"),
        "statement": bare,
    }
    return lines.where(c.rlike(AUDIT_LINE)).select(*keep, *[e.alias(n) for n, e in typed.items()])


def reads_per_object(audit: DataFrame, word: str = "email", by: Sequence[str] = ()) -> DataFrame:
    """Reads per object, and how many of their statements name a word."""
    named = F.lower("statement").rlike(rf"\b{word}\b")
    return (
        audit.where(F.col("class") == "READ")
        .groupBy(*by, "object_name")
        .agg(F.count(F.lit(1)).alias("reads"), F.count_if(named).alias("reads_naming_word"))
    )
