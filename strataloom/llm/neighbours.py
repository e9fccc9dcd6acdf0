"""Nearest neighbours by cosine: a block matrix join over int8 products with error bounds.

Unit vectors are rounded to int8 with a scale each, and the lengths of the
rounded vector and of the rounding error are kept, so the product of two rounded
vectors bounds the true cosine from both sides: |u.w - u'.w'| <= |e| |w| + |u'| |f|.
Vectors are dealt into groups by a hash of vec_id. Every group of queries meets
every group of candidates in one exchange and without a join: rows move as they
were read, queries come before candidates, and what a tile needs is derived where
it is used. There are as many groups of candidates as keep the copies of the
queries below the size of the candidates, and as many of queries as fit a task.
A task holds the queries of its group in blocks and lets the candidates stream by,
block by block. Each pair of blocks is one tile: the int8 products give the bounds,
pairs that cannot be among the k nearest are dropped, the others are recomputed in
double precision from the original vectors, and the k best of each query stay. The
best of different tasks are merged at the end.

Cases: vectors that are null, empty, zero, or hold null or non-finite values
take no part, nor do rows without vec_id. Of rows that repeat a vec_id the
shortest vector counts, then the smallest one in order of its values. Vectors
of different lengths are not compared. Ties go to the smaller vec_id. With
fewer than k candidates all are returned. An empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from strataloom.llm.batches import small_batches

CANDIDATES, QUERIES = 4096, 1024
HELD = 1 << 24  # values of query vectors in one group
SPREAD = 16  # groups of candidates, if there are as many blocks, even where the queries are many


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scales, lengths of the rounding errors, lengths of the rounded vectors."""
    largest = np.abs(vectors).max(1, keepdims=True)
    unit = vectors / largest
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    scale = np.abs(unit).max(1, keepdims=True) / 127
    codes = np.rint(unit / scale)
    rounded = codes * scale
    slack = 1 + 1e-9
    return codes.astype(np.int8), scale[:, 0], np.sqrt(((unit - rounded) ** 2).sum(1)) * slack + 1e-12, np.sqrt((rounded**2).sum(1)) * slack


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows in double precision, the same for equal rows wherever they stand."""
    scale = np.abs(left).max(1, keepdims=True)
    other = np.abs(right).max(1, keepdims=True)
    left, right = left / scale, right / other
    return np.clip((left * right).sum(1) / np.sqrt((left * left).sum(1) * (right * right).sum(1)), -1, 1)


class Block:
    """Vectors of one length by vec_id, with what a tile needs of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.codes, self.scales, self.errors, self.lengths = quantised(vectors.astype(np.float64))


class Queries(Block):
    """A block of queries and the k best of each so far: scores from high to low, and vec_ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        super().__init__(ids, vectors)
        self.k = k
        self.best, self.of = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)

    def meet(self, candidate: Block) -> None:
        """One tile: keep the candidates that are among the k nearest."""
        width = self.codes.shape[1]
        # One more column adds |u'| |f| to the product of u' and w'; what float32 may lose by that is below `slack`.
        left = np.empty((len(self.ids), width + 1), np.float32)
        right = np.empty((len(candidate.ids), width + 1), np.float32)
        left[:, :-1], left[:, -1] = self.codes * self.scales[:, None], self.lengths
        right[:, :-1], right[:, -1] = candidate.codes * candidate.scales[:, None], candidate.errors
        slack = (width + 8) * 2.0**-21
        upper = left @ right.T
        _, own, same = np.intersect1d(self.ids, candidate.ids, assume_unique=True, return_indices=True)
        upper[own, same] = -np.inf
        margin, floor = self.errors + slack, self.best[:, -1]
        if len(candidate.ids) > self.k and (floor == -np.inf).any():
            # the true cosine is at least the upper bound less twice the error
            reach = 2 * (margin + self.lengths * candidate.errors.max())
            floor = np.maximum(floor, np.partition(upper, -self.k, axis=1)[:, -self.k] + margin - reach)
        least = np.nextafter((floor - margin).astype(np.float32), np.float32(-np.inf))
        at, of = np.nonzero((upper >= least[:, None]) & (upper > -np.inf))
        if not len(at):
            return
        score = np.concatenate([cosines(self.vectors[at[a : a + 65536]].astype(np.float64), candidate.vectors[of[a : a + 65536]].astype(np.float64)) for a in range(0, len(at), 65536)])
        row, column = np.nonzero(self.best > -np.inf)
        at, score, ids = np.concatenate([row, at]), np.concatenate([self.best[row, column], score]), np.concatenate([self.of[row, column], candidate.ids[of]])
        by = np.lexsort((ids, -score, at))
        at, score, ids = at[by], score[by], ids[by]
        begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        rank = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
        use = rank < self.k
        self.best[at[use], rank[use]], self.of[at[use], rank[use]] = score[use], ids[use]

    def found(self) -> pa.RecordBatch:
        row, column = np.nonzero(self.best > -np.inf)
        return pa.RecordBatch.from_pydict({"query_id": self.ids[row], "vec_id": self.of[row, column], "score": self.best[row, column]})


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, vec_ids and vectors of the rows of each length."""
    column, ids = batch.column("embedding"), batch.column("vec_id").to_numpy()
    bounds, values = np.asarray(column.offsets).astype(np.int64), np.asarray(column.values)
    size = np.diff(bounds)
    for n in np.unique(size).tolist():
        use = np.flatnonzero(size == n)
        yield n, ids[use], values[bounds[use][:, None] + np.arange(n)]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of `vectors` nearest to each row of `queries` but itself."""
    spark = vectors.sparkSession
    small_batches(spark)
    plain = all(df.schema["embedding"].dataType == ArrayType(FloatType(), df.schema["embedding"].dataType.containsNull) for df in (vectors, queries))

    def usable(df: DataFrame) -> DataFrame:
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        kind = "array<float>" if plain else "array<double>"
        return df.select("vec_id", F.col("embedding").cast(kind).alias("embedding")).where("vec_id IS NOT NULL AND size(embedding) > 0").where(finite & F.exists("embedding", lambda x: x != 0))

    many = vectors.count()
    few, held = queries.agg(F.count(F.lit(1)), F.sum(F.greatest(F.size("embedding"), F.lit(0)))).first()
    groups = min(-(-many // CANDIDATES), max(SPREAD, many // max(few, 1))) or 1
    query_groups = -(-(held or 0) // HELD) or 1

    def dealt(df: DataFrame, own: str, count: int, other: str, copies: int, kind: int) -> DataFrame:
        group = F.pmod(F.xxhash64("vec_id", F.lit(kind)), F.lit(count)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other)
        return usable(df).select("vec_id", "embedding", group, F.lit(kind).alias("kind"), every).select("query_group", "own_group", "kind", "vec_id", "embedding")

    both = dealt(queries, "query_group", query_groups, "own_group", groups, 0).union(dealt(vectors, "own_group", groups, "query_group", query_groups, 1))
    order = ("query_group", "own_group", "kind", "vec_id", F.size("embedding"), "embedding")
    met = both.repartition(2 * groups * query_groups, "query_group", "own_group").sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Queries]] = {}  # blocks of the group's queries by length
        waiting: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}  # by kind and length, rows that do not fill a block yet
        current, last = None, None

        def settle(kind: int, size: int, whole: bool) -> None:
            """Turn waiting rows into blocks; the rest waits on unless `whole`."""
            most = CANDIDATES if kind else QUERIES
            ids, rows = (np.concatenate(c) for c in zip(*waiting.pop((kind, size)), strict=True))
            end = len(ids) if whole else len(ids) // most * most
            for a in range(0, end, most):
                part = ids[a : min(a + most, end)], rows[a : min(a + most, end)]
                if not kind:
                    held.setdefault(size, []).append(Queries(*part, k))
                elif size in held:
                    block = Block(*part)
                    for query in held[size]:
                        query.meet(block)
            if end < len(ids):
                waiting[kind, size] = [(ids[end:], rows[end:])]

        def close(*kinds: int) -> None:
            for kind, size in sorted(waiting):
                if kind in kinds:
                    settle(kind, size, True)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("query_group", "own_group", "kind", "vec_id")])
            before = np.concatenate([key[:, :1] if last is None else last, key[:, :-1]], axis=1)
            new = (key != before).any(0)  # of rows that repeat a vec_id the first
            new[0] |= last is None
            last = key[:, -1:]
            begins = np.append(np.flatnonzero(np.append(True, (key[:3, 1:] != key[:3, :-1]).any(0))), batch.num_rows)
            for a, b in zip(begins, begins[1:], strict=False):
                group, kind = tuple(key[:2, a]), int(key[2, a])
                if group != current:
                    close(0, 1)
                    yield from (query.found() for blocks in held.values() for query in blocks)
                    current, held = group, {}
                elif kind:
                    close(0)
                for size, ids, rows in _rows(batch.slice(a, b - a).filter(pa.array(new[a:b]))):
                    waiting.setdefault((kind, size), []).append((ids, rows))
                    if sum(len(x) for x, _ in waiting[kind, size]) >= (CANDIDATES if kind else QUERIES):
                        settle(kind, size, False)
        close(0, 1)
        yield from (query.found() for blocks in held.values() for query in blocks)

    found = met.select("query_group", "own_group", "kind", "vec_id", "embedding").mapInArrow(work, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
