"""Structured Streaming over files: transform, write, replay safely, fan out."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.operators.windows import first_per_key
from strataloom.sources.versioned import DayTable

Transform = Callable[[DataFrame], DataFrame]


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files of a table as a stream; new files become new batches."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything available to Parquet. The file sink keeps its own log of
    finished batches, so a batch that is retried is not written twice."""
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_keyed(stream: DataFrame, target: str, checkpoint: str, key: str, day: str) -> None:
    """Append rows whose key the target does not have yet, batch by batch.

    Delivering a batch twice, or the whole input again under a new checkpoint,
    adds nothing. Only the day folders that a batch touches are read back, and
    of them only the key; a key must therefore keep its day. The list of days
    that reaches the driver is no longer than the calendar of the batch.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("append").partitionBy(day).parquet(target)
    schema = stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = first_per_key(batch, [key], [c for c in schema.names if c != key]).persist()
        try:
            days = [r[0] for r in fresh.select(day).distinct().collect()]
            touched = F.col(day).isin([d for d in days if d is not None])
            if None in days:
                touched = touched | F.col(day).isNull()
            known = spark.read.schema(schema).parquet(target).where(touched).select(key)
            fresh.join(known, key, "left_anti").select(schema.names).hint("rebalance", day).write.mode("append").partitionBy(day).parquet(target)
        finally:
            fresh.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_upserts(stream: DataFrame, table: DayTable, checkpoint: str, key: str, version: str) -> None:
    """Insert rows by key and replace those of an older version, batch by batch.

    The day folders that a batch touches are read, merged and written anew
    beside the old ones; one step makes them count, together with the number of
    the batch. A batch that is delivered again finds its number and changes
    nothing, and a replay under a new checkpoint finds no newer version. Of
    equal versions the row that is there stays. A key keeps its day. What
    reaches the driver is the list of days of a batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        number, before = table.last()
        if before["marks"].get(checkpoint, -1) >= batch_id:
            return
        ties = [F.col(c) for c in table.schema.names if c not in (key, version)]
        latest = first_per_key(batch.select(table.schema.names), [key], [F.col(version).desc_nulls_last(), *ties]).persist()
        try:
            days = [r[0] for r in latest.select(table.day).distinct().collect()]
            there = table.read(days).withColumn("_new", F.lit(0))
            merged = first_per_key(there.unionByName(latest.withColumn("_new", F.lit(1))), [key], [F.col(version).desc_nulls_last(), "_new"])
            table.replace(merged.drop("_new"), days, marks={checkpoint: batch_id}, after=number)
        finally:
            latest.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def fan_out(spark: SparkSession, path: str, schema: T.StructType, subscribers: Mapping[str, Transform], root: str) -> dict[str, str]:
    """Several independent readers of one source, each with its own progress."""
    targets = {}
    queries = []
    for name, transform in subscribers.items():
        targets[name] = f"{root}/{name}/data"
        queries.append(
            transform(read_stream(spark, path, schema))
            .writeStream.format("parquet")
            .option("path", targets[name])
            .option("checkpointLocation", f"{root}/{name}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    for query in queries:
        query.awaitTermination()
    return targets
