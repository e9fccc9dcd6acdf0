"""Packing of documents into as few sequences as possible by a grouping genetic algorithm.

Documents are cut into pieces of at most `CAPACITY` tokens. Full pieces are
sequences of their own. All others are dealt at random into groups of about
`GROUP` pieces, and several islands evolve packings of a group: crossover
injects well-filled sequences of one parent whole into the other, removes the
sequences that hold a piece twice, and puts the displaced pieces back best fit,
largest first. Between epochs the best packing of each island moves to the next
island of its group. Sequences that waste at most `WASTE` stay; the pieces of
the others are dealt and packed again together with those of other groups, until one
group is left or no more than a fifth is gained. No group grows with the input.

Cases: a null or empty text is one piece with only the closing token. Every row
is packed, repeated rows and rows without doc_id included. An empty table gives
no rows. Other columns are not looked at.
"""

from __future__ import annotations

import bisect
import math
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.batches import small_batches
from strataloom.llm.bpe import vocabulary
from strataloom.session import new_dir

CAPACITY = 2048
CLOSING = 0
GROUP = 2000
WASTE = 0.01
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 12, 4


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces; the first takes what does not fill a piece."""
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces of all rows."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            ids, counts = bpe.encode(batch.column("text"))
            ends = np.cumsum(counts)
            out: list[tuple[int, int, int, int, int]] = []
            for row, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
                whole = memoryview(np.append(ids[a:b], np.uint32(closing)).astype("<u4").tobytes())
                start = 0
                for piece, length in enumerate(cut_lengths(b - a + 1, capacity)):
                    out.append((row, piece, start, length, zlib.crc32(whole[4 * start : 4 * (start + length)])))
                    start += length
            row, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*out, strict=True)) if out else [np.empty(0, np.int64)] * 5
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(row)), "piece": pa.array(piece, pa.int32()), "start": start, "length": length, "ids_crc32": crc})

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


class Packing:
    """Bins of item numbers, open to best-fit insertion."""

    def __init__(self, sizes: list[int], capacity: int, bins: list[list[int]]):
        self.sizes, self.capacity = sizes, capacity
        self.bins = bins
        self.room = [capacity - sum(sizes[i] for i in b) for b in bins]

    def best_fit(self, items: list[int]) -> Packing:
        """Put items into the fullest bins that take them, largest first."""
        rooms = sorted((r, n) for n, r in enumerate(self.room))
        for i in sorted(items, key=lambda i: (-self.sizes[i], i)):
            at = bisect.bisect_left(rooms, (self.sizes[i], -1))
            if at < len(rooms):
                room, n = rooms.pop(at)
                self.bins[n] = [*self.bins[n], i]
            else:
                room, n = self.capacity, len(self.bins)
                self.bins.append([i])
                self.room.append(room)
            self.room[n] = room - self.sizes[i]
            bisect.insort(rooms, (self.room[n], n))
        return self

    def fitness(self) -> float:
        """Mean squared fill: of equally many bins, full and empty ones beat even ones."""
        return sum((1 - r / self.capacity) ** 2 for r in self.room) / max(len(self.bins), 1)

    def rank(self) -> tuple[int, float]:
        return len(self.bins), -self.fitness()


def cross(giver: Packing, taker: Packing, rnd: random.Random) -> Packing:
    """Inject well-filled bins of `giver`, drop the bins of `taker` they overlap, re-insert what that displaced."""
    by_room = sorted(range(len(giver.bins)), key=lambda n: giver.room[n])
    chosen = [n for n in by_room[: max(1, len(by_room) // 2)] if rnd.random() < 0.5] or by_room[:1]
    injected = [giver.bins[n] for n in chosen]
    taken = {i for b in injected for i in b}
    stay, displaced = [], []
    for b in taker.bins:
        if taken.isdisjoint(b):
            stay.append(b)
        else:
            displaced += [i for i in b if i not in taken]
    return Packing(giver.sizes, giver.capacity, injected + stay).best_fit(displaced)


def mutate(packing: Packing, rnd: random.Random) -> Packing:
    """Empty the least filled bins and a few others, and re-insert their items."""
    order = sorted(range(len(packing.bins)), key=lambda n: -packing.room[n])
    out = set(order[: max(2, len(order) // 50)]) | {rnd.randrange(len(order)) for _ in range(3)}
    left = [b for n, b in enumerate(packing.bins) if n not in out]
    return Packing(packing.sizes, packing.capacity, left).best_fit([i for n in sorted(out) for i in packing.bins[n]])


def evolve(sizes: list[int], capacity: int, seed: int, elites: list[list[int]], generations: int = GENERATIONS) -> list[int]:
    """The bin of every item in the best packing found; `elites` are packings to begin with."""
    rnd = random.Random(seed)
    least = math.ceil(sum(sizes) / capacity)
    population = [Packing(sizes, capacity, []).best_fit(list(range(len(sizes))))]
    for bins in elites:
        found: dict[int, list[int]] = {}
        for i, n in enumerate(bins):
            found.setdefault(n, []).append(i)
        population.append(Packing(sizes, capacity, list(found.values())))
    while len(population) < POPULATION:
        population.append(mutate(population[0], rnd))
    for _ in range(generations):
        population.sort(key=Packing.rank)
        if len(population[0].bins) <= least:
            break
        giver, taker = population[0], population[rnd.randrange(1, len(population))]
        population[-1] = cross(giver, taker, rnd)
        population.append(mutate(cross(taker, giver, rnd), rnd))
        population = sorted(population, key=Packing.rank)[:POPULATION]
    best = min(population, key=Packing.rank)
    where = [0] * len(sizes)
    for n, b in enumerate(best.bins):
        for i in b:
            where[i] = n
    return where


def _epoch(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One epoch of every island: part, island, lengths, elites -> best packing and its rank."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                sizes = [int(x) for x in r.lengths]
                bins = evolve(sizes, capacity, (epoch * 1009 + r.island) * 1_000_003 + r.part, [list(map(int, e)) for e in r.elites])
                rank = Packing(sizes, capacity, _bins_of(bins)).rank()
                rows.append((r.part, r.island, sizes, bins, rank[0], rank[1]))
            yield pd.DataFrame(rows, columns=["part", "island", "lengths", "bins", "n_bins", "unfit"])

    return islands.mapInPandas(work, "part bigint, island int, lengths array<bigint>, bins array<bigint>, n_bins bigint, unfit double")


def _bins_of(bins: list[int]) -> list[list[int]]:
    found: dict[int, list[int]] = {}
    for i, n in enumerate(bins):
        found.setdefault(n, []).append(i)
    return list(found.values())


def _packed_groups(items: DataFrame, parts: int, capacity: int, level: int) -> DataFrame:
    """All items with their bin (part, bin), offset there and the bin's waste."""
    columns = [c for c in items.columns if c != "part"]
    dealt = items.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level), "row"), F.lit(parts)))
    groups = dealt.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("length", *[c for c in columns if c != "length"]))).alias("items"))
    path = new_dir(items.sparkSession, "groups")
    groups.write.parquet(path)
    groups = items.sparkSession.read.parquet(path)
    start = groups.select("part", F.expr("transform(items, i -> i.length)").alias("lengths")).withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    islands = start.withColumn("elites", F.expr("cast(array() as array<array<bigint>>)")).repartition("part", "island")
    for epoch in range(EPOCHS):
        islands = _epoch(islands, capacity, epoch)
        if epoch < EPOCHS - 1:  # the elite of each island moves on to the next one of its group
            moved = islands.select("part", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.col("bins").alias("guest"))
            islands = islands.join(moved, ["part", "island"]).select("part", "island", "lengths", F.array("bins", "guest").alias("elites"))
    best = islands.groupBy("part").agg(F.min_by("bins", F.struct("n_bins", "unfit", "island")).alias("bins"))
    placed = groups.join(best, "part").select("part", F.inline(F.arrays_zip("items", "bins"))).select("part", F.col("bins").alias("bin"), "items.*")
    bin_ = Window.partitionBy("part", "bin")
    before = F.sum("length").over(bin_.orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(before, F.lit(0))).withColumn("filled", F.sum("length").over(bin_))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, closing: int = CLOSING, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    folder = new_dir(spark, "pieces")
    pieces(docs, path, capacity, closing).write.parquet(folder)
    rows = spark.read.parquet(folder).withColumn("row", F.monotonically_increasing_id())
    result = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    done = [rows.where(F.col("length") == capacity).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("row") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    items = rows.where(F.col("length") < capacity)
    count, level = items.count(), 0
    while count:
        parts = max(1, round(count / group))
        folder = new_dir(spark, "packed")
        _packed_groups(items, parts, capacity, level).write.parquet(folder)
        placed = spark.read.parquet(folder)
        number = F.lit(level << 56) + F.col("part") * (1 << 24) + F.col("bin")
        poor = F.col("filled") < capacity * (1 - WASTE)
        left = placed.where(poor).count() if parts > 1 else 0
        if left > 0.8 * count:
            left = 0
        done.append((placed.where(~poor) if left else placed).withColumn("sequence_id", number).select(*result))
        items, count, level = placed.where(poor).drop("part", "bin", "filled", "offset"), left, level + 1
    answer = done[0]
    for more in done[1:]:
        answer = answer.unionByName(more)
    return answer.select(*result)
