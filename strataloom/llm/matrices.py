"""Documents as packed matrices of token ids, best fit decreasing, written as binary rows.

Every task encodes its documents, keeps up to `WINDOW` tokens at a time, cuts
documents longer than a row losslessly and packs the pieces into rows of
`WIDTH` ids, largest first, each into the fullest row that takes it. A segment
tree over the room left (0..WIDTH) finds that row. Nothing is shuffled, and
what is held does not grow with the input. A written row holds its ids (unsigned
little-endian, 16 bits if the vocabulary allows, else 32, padded), the cumulative
segment lengths, the places where positions restart, and for each segment the
document and the place in it.

Cases: a null or empty text is a segment with only the closing token. Every row
of the table is written, repeated ones and those without doc_id too. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.batches import small_batches
from strataloom.llm.bpe import vocabulary

WIDTH = 2048
WINDOW = 4_000_000
CLOSING = 50256
SCHEMA = "shard int, window int, row int, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<bigint>, starts array<bigint>"


class RoomTree:
    """Segment tree over room sizes: which sizes have an open row, and the smallest that suffices."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at:
            self.open[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the least room >= `least`."""
        at = least + self.leaves
        if not self.open[at]:
            while at > 1 and (at & 1 or not self.open[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.open[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            self.open[at] -= 1
            at >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """The row of every piece and the number of rows."""
    tree, where, rows = RoomTree(width), np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = tree.take(length)
        if found is None:
            found, rows = (width, rows), rows + 1
        where[i] = found[1]
        tree.add(found[0] - length, found[1])
    return where, rows


def _matrix(ids: list[np.ndarray], doc_ids: list[int | None], shard: int, window: int, width: int, kind: str, padding: int) -> pa.RecordBatch:
    doc, start, length, data = [], [], [], np.concatenate(ids)
    for n, x in enumerate(ids):
        for at in range(0, len(x), width):
            doc.append(n)
            start.append(at)
            length.append(min(width, len(x) - at))
    length, start = np.array(length), np.array(start)
    row, rows = best_fit_decreasing(length, width)
    by = np.argsort(row, kind="stable")
    base = np.append(0, np.cumsum([len(x) for x in ids]))[np.array(doc)] + start
    matrix = np.full((rows, width), padding, kind)
    heads = np.searchsorted(row[by], np.arange(rows + 1))
    cumulative, owners, places, totals = [], [], [], []
    for r in range(rows):
        own = by[heads[r] : heads[r + 1]]
        at = 0
        marks = [0]
        for i in own.tolist():
            matrix[r, at : at + length[i]] = data[base[i] : base[i] + length[i]]
            at += int(length[i])
            marks.append(at)
        cumulative.append(marks)
        owners.append([doc_ids[doc[i]] for i in own])
        places.append(start[own].tolist())
        totals.append(at)
    return pa.RecordBatch.from_pydict(
        {
            "shard": pa.array([shard] * rows, pa.int32()), "window": pa.array([window] * rows, pa.int32()), "row": pa.array(range(rows), pa.int32()), "n_tokens": pa.array(totals, pa.int32()),
            "ids": pa.array([m.tobytes() for m in matrix], pa.binary()), "cu_seqlens": pa.array(cumulative, pa.list_(pa.int32())), "resets": pa.array([c[:-1] for c in cumulative], pa.list_(pa.int32())),
            "doc_ids": pa.array(owners, pa.list_(pa.int64())), "starts": pa.array(places, pa.list_(pa.int64())),
        }
    )


def matrix_rows(docs: DataFrame, path: str | None = None, width: int = WIDTH, window: int = WINDOW, closing: int = CLOSING, padding: int = CLOSING) -> DataFrame:
    """SCHEMA rows: the matrix of window w of shard s is its rows 0, 1, ... one below the other."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, shard, number = vocabulary(path), TaskContext.get().partitionId(), 0
        kind = "<u2" if max(len(bpe.tokens), closing + 1, padding + 1) <= 1 << 16 else "<u4"
        held: list[np.ndarray] = []
        owners: list[int | None] = []
        size = 0
        for batch in batches:
            ids, counts = bpe.encode(batch.column("text"))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), np.split(ids.astype(kind), np.cumsum(counts)[:-1]), strict=True) if batch.num_rows else []:
                held.append(np.append(own, np.array([closing], kind)))
                owners.append(doc_id)
                size += len(own) + 1
                if size >= window:
                    yield _matrix(held, owners, shard, number, width, kind, padding)
                    held, owners, size, number = [], [], 0, number + 1
        if held:
            yield _matrix(held, owners, shard, number, width, kind, padding)

    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA)


def write_matrices(docs: DataFrame, folder: str, **options) -> DataFrame:
    """Write the matrices of `docs` to Parquet and return them as read again."""
    matrix_rows(docs, **options).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def segments(matrices: DataFrame) -> DataFrame:
    """shard, window, row, doc_id, start, offset, length: one row per segment of written matrices."""
    parts = F.arrays_zip("doc_ids", "starts", "resets", F.expr("slice(cu_seqlens, 2, size(doc_ids))").alias("ends"))
    return matrices.select("shard", "window", "row", F.inline(parts)).selectExpr("shard", "window", "row", "doc_ids AS doc_id", "starts AS start", "resets AS offset", "ends - resets AS length")
