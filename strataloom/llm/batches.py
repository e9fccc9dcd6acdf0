"""Helpers of operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, StructField, StructType

ROWS_PER_BATCH, BYTES_PER_BATCH = 1000, "4m"
UNPACKED = 4 << 20  # bytes of texts unpacked in one go, if they are several


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at a time: whole rows, but few of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column, one text after the other, and the n + 1 bounds of the texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("", column.type) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.scalar(b"", column.type))
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs (start, length), one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def binary_column(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column: row i holds the bytes of the next counts[i] items of `data`."""
    bounds = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * data.itemsize, out=bounds[1:])
    if bounds[-1] < 2**31 - 1:
        return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    whole = pa.py_buffer(np.ascontiguousarray(data))
    return pa.array([whole[a:b].to_pybytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary())


def packed(rows: DataFrame, name: str) -> DataFrame:
    """`rows` with each text of a column compressed by itself, behind its size: what is shuffled is smaller."""
    schema = StructType([StructField(f.name, BinaryType()) if f.name == name else f for f in rows.schema])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for batch in batches:
            raw, bounds = utf8(batch.column(name))
            texts = [raw[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            small = pa.array([len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([small if c == name else batch.column(c) for c in batch.schema.names], batch.schema.names)

    return rows.mapInArrow(work, schema)


def unpacked(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """The batches with the texts of a column as they were before `packed`, few at a time; texts not packed stay as they are."""
    codec = pa.Codec("zstd")
    for batch in batches:
        at = batch.schema.names.index(name)
        if not pa.types.is_binary(batch.column(at).type) or not batch.num_rows:
            yield batch
            continue
        raw, bounds = utf8(batch.column(at))
        size = np.array([int.from_bytes(raw[a : a + 8].tobytes(), "little") for a in bounds[:-1]], np.int64)
        begin = 0
        while begin < batch.num_rows:
            end = begin + max(1, int(np.searchsorted(np.cumsum(size[begin:]), UNPACKED, side="right")))
            texts = [codec.decompress(raw[bounds[i] + 8 : bounds[i + 1]].tobytes(), int(size[i]), asbytes=True) for i in range(begin, end)]
            part = batch.slice(begin, end - begin)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()) if i == at else part.column(i) for i in range(part.num_columns)], part.schema.names)
            begin = end
