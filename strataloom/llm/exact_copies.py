"""Exact copies of documents by recipes of content-defined chunks, in DataFrame functions only.

Every text is cut where its content says so: after at least `MIN_CHUNK`
characters at white space that stands before one of a-e, or after `MAX_CHUNK`
characters. A chunk is named by a 64-bit hash; a name is verified when all
chunks that bear it are the same text. A document is then the ordered list of
its chunk names, a row of a few bytes, and equal lists of verified names mean
equal texts. Texts holding a name that two different chunks share are compared
whole. Chunk texts move once, after copies within a task are merged; whole
documents never move.

Cases: a null text counts as empty. Rows with a null doc_id take part; null is
smaller than any id, so it stays only in a group without ids. Rows that repeat
doc_id and text are one document: all of them carry the same `kept`, keep_rows
counts them, and `drop_copies` leaves one. Other columns are never looked at. An empty table
gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.session import cut_lineage

MIN_CHUNK, MAX_CHUNK = 400, 4000


def normalised(text: Column) -> Column:
    """Text with A-Z in lower case and nothing else changed."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The content-defined chunks of a text, in order; together they are the text."""
    pattern = rf"(?s).{{{least},{most}}}?[ \n](?=[a-e])|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256 and the ordered chunk names of every row."""
    text = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    return text.select(
        "doc_id",
        F.sha2("norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("norm")), lambda c: F.xxhash64(c)).alias("recipe"),
    )


def shared_names(docs: DataFrame) -> DataFrame:
    """Chunk names borne by two or more different chunk texts (as a rule none)."""
    pieces = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    dictionary = pieces.groupBy(F.xxhash64("chunk").alias("name"), "chunk").agg(F.count(F.lit(1)).alias("n"))
    return dictionary.groupBy("name").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("name")


def exact_copies(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, keep_rows.

    keep_id is the largest doc_id among the rows of equal text, kept says
    whether the row bears it, keep_rows counts the rows of the group that do.
    """
    docs = docs.select("doc_id", "text")
    rows = cut_lineage(recipes(docs).withColumn("rid", F.xxhash64("recipe")))
    doubtful = rows.select("rid", F.explode(F.array_distinct("recipe")).alias("name")).join(shared_names(docs), "name", "left_semi").select("rid").distinct()
    # Counts of equal rows first, so that no later shuffle meets a large group of copies.
    same_id = rows.groupBy("rid", "recipe", "text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    texts = same_id.groupBy("rid", "recipe", "text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"), F.coalesce(F.max_by("n", "doc_id"), F.sum("n")).alias("keep_rows")
    )
    # The digest of the whole text decides where a name is not verified.
    whole = F.when(F.col("doubt"), F.col("text_sha256")).otherwise("")
    marked = texts.join(doubtful.withColumn("doubt", F.lit(True)), "rid", "left").withColumn("whole", whole)
    groups = marked.groupBy("rid", "recipe", "whole").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.coalesce(F.max_by("keep_rows", "keep_id"), F.sum("keep_rows")).alias("keep_rows")
    )
    equal = (rows["rid"] == groups["rid"]) & (rows["recipe"] == groups["recipe"]) & (groups["whole"].isin("") | (groups["whole"] == rows["text_sha256"]))
    return rows.join(groups, equal).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "keep_rows"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, without later copies; of repeated rows one is left."""
    id_, sha, n = "_kept_id", "_kept_sha", "_kept_rows"
    stay = exact_copies(docs).where("kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha), F.col("keep_rows").alias(n)).distinct()
    digest = F.sha2(normalised(docs["text"]), 256)
    joined = docs.join(stay, docs["doc_id"].eqNullSafe(stay[id_]) & (digest == stay[sha]))
    once = joined.where(f"{n} = 1").select(*[docs[c] for c in docs.columns])
    repeated = joined.where(f"{n} > 1").dropDuplicates([id_, sha]).select(*[docs[c] for c in docs.columns])
    return once.unionByName(repeated)
