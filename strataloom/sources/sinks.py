"""Writers. Each one may be run again with the same input without changing the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace the whole table at `path`."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> str:
    """Hive-style folders with few, even files.

    REBALANCE brings rows of a folder together and lets AQE split a folder that
    holds far more rows than the others, so one hot month is not one task.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> str:
    """Overwrite only the folders present in `df`; all others stay."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    return path


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Managed table, replaced as a whole."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """Managed table dealt into a fixed number of buckets by a key, each sorted by it.

    Tables with equal buckets meet on that key without a shuffle or a sort, so
    the price of dealing the rows is paid once for all later joins and
    groupings. Rows are dealt before the write, so a bucket is one file. A key
    that holds a large part of the rows makes one large bucket, which nothing
    splits later; such tables are better joined by shuffle, where AQE splits it.
    """
    df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    return df.sparkSession.table(name)


def use_layer(spark: SparkSession, name: str, location: str) -> str:
    """Database that stands for one layer (staging, intermediate, analytics)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


def stamped(df: DataFrame, column: str = "loaded_at") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def compact(spark: SparkSession, source: str, target: str, target_mb: int = 128, by: list[str] | None = None) -> str:
    """Rewrite many small files into fewer of about `target_mb` each, folders (`by`) kept.

    REBALANCE sizes the files by the advisory partition size, without a count
    beforehand and without dealing every row anew. The new copy goes to another
    path; readers switch when it is complete.
    """
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, f"{target_mb}m")
    try:
        rows = spark.read.parquet(source)
        writer = rows.hint("rebalance", *(by or [])).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(target)
    finally:
        spark.conf.set(setting, before)
    return target


def file_layout(df: DataFrame) -> DataFrame:
    """Files of a table with their size and row count."""
    meta = F.col("_metadata")
    return (
        df.select(meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size"))
        .groupBy("file_path")
        .agg(F.max("file_size").alias("bytes"), F.count(F.lit(1)).alias("row_count"))
    )


def partition_layout(df: DataFrame, by: list[str]) -> DataFrame:
    """Folders of a partitioned table with files, bytes and rows."""
    meta = F.col("_metadata")
    files = (
        df.select(*by, meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size"))
        .groupBy(*by, "file_path")
        .agg(F.max("file_size").alias("bytes"), F.count(F.lit(1)).alias("row_count"))
    )
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("bytes"), F.sum("row_count").alias("row_count")
    )
