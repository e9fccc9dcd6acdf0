"""Connected components of a table of links, never gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of `links` (a, b) of type bigint.

    Alternates two star steps until nothing changes: each node hands the
    smallest of its neighbours first to its larger neighbours, then to its
    smaller ones and itself. The number of rounds grows with the logarithm of
    the longest path. Links with a null end, and self-links, are ignored.
    """
    edges = links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("v < u").distinct()
    edges, before = cut_lineage(edges), None
    while True:
        both = edges.union(edges.select("u", "v")).toDF("near", "at")
        low = both.groupBy("at").agg(F.min("near").alias("low"))
        wide = both.join(low, "at").where("near > at").select(F.least("low", "at").alias("v"), F.col("near").alias("u")).where("v < u").distinct()
        low = wide.groupBy("u").agg(F.min("v").alias("low"))
        near = wide.join(low, "u").where("v > low").select(F.col("low").alias("v"), F.col("v").alias("u"))
        edges = cut_lineage(near.union(low.select(F.col("low").alias("v"), "u")).distinct())
        # A sum over few columns needs far fewer tasks than the shuffles had.
        state = edges.coalesce(1 + int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16).agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
