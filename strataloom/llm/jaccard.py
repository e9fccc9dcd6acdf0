"""N-gram Jaccard join of whole texts, exact, without listing the pairs of a group.

A text is the set of its word shingles. Sets are tiled by size band: in a band,
the hash space is cut into one more segment than two linked sets of that size
can have different members, so linked sets agree on a whole segment. A tile is
the sets of one band (or the edge of the next smaller one) with equal members
in one segment. Pairs of a tile are compared first by bitmaps, whose bits set
on one side alone bound the overlap from above, then by exact intersection of
sorted arrays. A first round compares a tile's sets with its leading set only;
then linked sets are one component, and tiles that hold one component are done.
What is left of a tile is compared in whole, block by block: by bitmaps first,
where a step passes on only as many open pairs as would join all sets that
bitmaps leave open, fewer than it has sets. Those pairs connect components to
groups. Sets in any open pair come once, with their members, to their group,
where blocks of them are intersected inside the task; again a step passes on
fewer links than it has sets. So every pair of a tile is compared or already
connected, and no step passes on the pairs of a group.

Members are 64-bit hashes, sets are named by 128 bits. A segment that is empty on both sides says
nothing; sets with an empty segment are segmented again with other seeds, and a
link escapes only if its differences hit every segment not empty, under all of
them (below 1e-7 for links at the very limit, nil for all others).

Cases: null texts and texts without words are empty sets, linked with nothing.
Rows of equal doc_id are one node: what one is linked to, all are. Rows without
doc_id are returned with their set size and a null component. An empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.batches import binary_column, small_batches, utf8
from strataloom.llm.components import components
from strataloom.llm.words import ODD, mix, shingle_sets
from strataloom.session import new_dir

BITS = 1024
LEADERS = (1,)  # leading sets of a tile in the rounds before whole tiles are compared
NAME = ["set_hash", "set_hash2"]
BLOCK = 2048  # sets of a tile that meet the sets of another block in one step
EXACT_BLOCK = 512  # the same where sets come with their members


class Bands:
    """Size bands and segments for the threshold numerator / denominator."""

    def __init__(self, numerator: int, denominator: int):
        self.numerator, self.denominator = numerator, denominator
        edges, ratio = [1], max(1.4, 1.05 * denominator / numerator)
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] * ratio))))
        self.edges = np.array(edges)
        most = 2 * (self.edges[1:] - 1)
        self.segments = most * (denominator - numerator) // (denominator + numerator) + 1

    def keys(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tile keys of sorted sets, and the set each belongs to."""
        band = np.searchsorted(self.edges, np.maximum(counts, 1), side="right") - 1
        reaches = counts * self.denominator // self.numerator >= self.edges[band + 1]
        keys, owners = [], []
        for extra in (0, 1):
            chosen = np.flatnonzero((counts > 0) & (reaches if extra else True))
            for seed in range(6):
                if not len(chosen):
                    break
                key, owner, filled = self._segment_keys(hashes, counts, chosen, band[chosen] + extra, seed)
                keys.append(key)
                owners.append(owner)
                parts = self.segments[band[chosen] + extra]
                again = np.where(parts <= 8, 6, np.where(parts <= 32, 2, 1))
                chosen = chosen[(filled < parts) & (seed + 1 < again)]
        return np.concatenate(keys) if keys else np.empty(0, np.uint64), np.concatenate(owners) if owners else np.empty(0, np.int64)

    def _segment_keys(self, hashes, counts, chosen, band, seed):
        ends = np.cumsum(counts)
        sizes = counts[chosen]
        owner = np.repeat(np.arange(len(chosen)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat((ends - counts)[chosen], sizes)
        members = hashes[at]
        if seed:
            members = mix(members + np.uint64(ODD * seed & (1 << 64) - 1))
            order = np.lexsort((members, owner))
            members, owner = members[order], owner[order]
        parts = self.segments[band].astype(np.uint64)
        segment = ((members >> np.uint64(32)) * parts[owner]) >> np.uint64(32)
        begins = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])))
        content = np.add.reduceat(mix(members ^ np.uint64(ODD)), begins)
        where = (band[owner[begins]].astype(np.uint64) << np.uint64(40)) + segment[begins] * np.uint64(8) + np.uint64(seed)
        return mix(content + mix(where)), chosen[owner[begins]], np.bincount(owner[begins], minlength=len(chosen))


def bitmaps(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of BITS bits per set."""
    rows = np.zeros((len(counts), BITS), bool)
    rows[np.repeat(np.arange(len(counts)), counts), (hashes & np.uint64(BITS - 1)).astype(np.int64)] = True
    return np.packbits(rows, axis=1)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, the two halves of a 128-bit name of the set, and bitmap of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = shingle_sets(*utf8(batch.column("text")), words)
            name, second = _names(hashes, counts)
            marks = bitmaps(hashes, counts)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": counts.astype(np.int64), "set_hash": name, "set_hash2": second, "bitmap": pa.array([m.tobytes() for m in marks], pa.binary())})

    return docs.mapInArrow(work, "doc_id bigint, n_shingles bigint, set_hash bigint, set_hash2 bigint, bitmap binary")


def _names(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set."""
    ends, halves = np.cumsum(counts), []
    for salt in (0xA5A5A5A5A5A5A5A5, 0xC3C3C3C3C3C3C3C3):
        whole = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)))])
        halves.append(mix((whole[ends] - whole[ends - counts]) + counts.astype(np.uint64)).view(np.int64))
    return halves[0], halves[1]


def _tile_rows(docs: DataFrame, words: int, bands: Bands) -> DataFrame:
    """tile, doc_id: the tiles of every different set of a batch, under one of its documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = shingle_sets(*utf8(batch.column("text")), words)
            first = np.zeros(len(counts), bool)
            first[np.unique(np.stack(_names(hashes, counts)), axis=1, return_index=True)[1]] = True
            hashes, counts = hashes[np.repeat(first, counts)], np.where(first, counts, 0)
            keys, owner = bands.keys(hashes, counts)
            ids = batch.column("doc_id").take(pa.array(owner))
            for a in range(0, len(keys), 1 << 17):
                yield pa.RecordBatch.from_pydict({"tile": keys[a : a + (1 << 17)].view(np.int64), "doc_id": ids[a : a + (1 << 17)]})

    return docs.where("doc_id IS NOT NULL").mapInArrow(work, "tile bigint, doc_id bigint")


def _crowded(rows: DataFrame) -> DataFrame:
    """The rows (tile, doc_id) whose tile has several rows: one exchange by tile, then neighbours in a stream."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = np.empty((2, 0), np.int64), False  # the last row, and whether its tile has a row before it
        for batch in batches:
            if not batch.num_rows:
                continue
            both = np.concatenate([held, np.stack([np.asarray(batch.column(c)) for c in ("tile", "doc_id")])], axis=1)
            same = both[0, 1:] == both[0, :-1]
            before = np.append(known, same)
            keep = before[:-1] | same
            yield pa.RecordBatch.from_pydict({"tile": both[0, :-1][keep], "doc_id": both[1, :-1][keep]})
            held, known = both[:, -1:], bool(before[-1])
        if known:
            yield pa.RecordBatch.from_pydict({"tile": held[0], "doc_id": held[1]})

    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(work, "tile bigint, doc_id bigint")


def _may_link(pairs: DataFrame, bands: Bands) -> DataFrame:
    """The pairs whose bitmaps do not rule a link out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("bits_a", "bits_b"))
            n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            only_left = np.bitwise_count(left & ~right).sum(1, dtype=np.int64)
            only_right = np.bitwise_count(right & ~left).sum(1, dtype=np.int64)
            overlap = np.minimum(n - only_left, m - only_right)
            fits = bands.denominator * overlap >= bands.numerator * (n + m - overlap)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(fits))

    return pairs.mapInArrow(work, "a bigint, b bigint")


def _blocks(tiles: DataFrame, most: int) -> DataFrame:
    """The rows of each tile (tile, node, …), dealt into steps (tile, i, j) in which two blocks of its sets meet.

    Tiles of at most `most` sets are one step. `own` is the block of the row.
    """
    size = tiles.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = tiles.join(size, "tile").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).select("*", other)
    step = (F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return rows.select("tile", *step, "own", *[c for c in tiles.columns if c != "tile"])


class Parts:
    """Union-find over the components of one step."""

    def __init__(self, component: np.ndarray):
        names, self.part = np.unique(component, return_inverse=True)
        self.parent = list(range(len(names)))

    def root(self, part: int) -> int:
        parent = self.parent
        while parent[part] != part:
            parent[part] = parent[parent[part]]
            part = parent[part]
        return part

    def join(self, x: int, y: int) -> bool:
        """Whether the rows were in different parts, which are now one."""
        a, b = self.root(self.part[x]), self.root(self.part[y])
        self.parent[max(a, b)] = min(a, b)
        return a != b

    def roots(self) -> np.ndarray:
        return np.array([self.root(p) for p in range(len(self.parent))], np.int64)[self.part]


def _open_pairs(step: dict[str, np.ndarray], bits: np.ndarray, parts: Parts | np.ndarray, bands: Bands) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (x, y) of a step in different parts, now or as they were, that the bitmaps do not rule out; some at a time, each pair once."""
    first, second = np.flatnonzero(step["own"] == step["i"]), np.flatnonzero(step["own"] == step["j"])
    within = len(step["own"]) > 0 and step["i"][0] == step["j"][0]
    for a in range(0, len(first), 64):
        left, right = first[a : a + 64], second[a + 1 :] if within else second
        if not len(right):
            return
        only = np.bitwise_count(bits[left][:, None] & ~bits[right]).sum(2, dtype=np.int64)
        others = np.bitwise_count(bits[right] & ~bits[left][:, None]).sum(2, dtype=np.int64)
        n, m = step["n"][left][:, None], step["n"][right]
        overlap = np.minimum(n - only, m - others)
        roots = parts.roots() if isinstance(parts, Parts) else parts
        fits = (bands.denominator * overlap >= bands.numerator * (n + m - overlap)) & (roots[left][:, None] != roots[right])
        if within:
            fits &= left[:, None] < right
        x, y = np.nonzero(fits)
        yield left[x], right[y]


def _in_steps(rows: DataFrame, schema: str, judge) -> DataFrame:
    """Apply `judge(columns, bits, arrays)` to every step; only the rows of one step are held at a time."""
    names = ["tile", "i", "j", "own", "node", "component", "n"]
    with_arrays = "hashes" in rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[pa.RecordBatch] = []

        def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = {c: table.column(c).to_numpy().astype(np.int64) for c in names}
            marks = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, BITS // 64)
            key = np.stack([columns[c] for c in ("tile", "i", "j")])
            begins = np.append(np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0))), len(marks))
            for a, b in zip(begins, begins[1:], strict=False):
                if b - a > 1:
                    arrays = [np.frombuffer(h, np.uint64) for h in table.column("hashes").slice(a, b - a).to_pylist()] if with_arrays else []
                    yield pa.RecordBatch.from_pydict(judge({c: v[a:b] for c, v in columns.items()}, marks[a:b], arrays))

        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("tile", "i", "j")]
            same = np.ones(batch.num_rows, bool)
            for c, v in zip(("tile", "i", "j"), last, strict=True):
                same &= np.asarray(batch.column(c)) == v
            end = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if end:
                yield from settled(pa.Table.from_batches([*pieces, batch.slice(0, end)]))
                pieces = []
            elif pieces and [pieces[0].column(c)[0].as_py() for c in ("tile", "i", "j")] != last:
                yield from settled(pa.Table.from_batches(pieces))
                pieces = []
            pieces.append(batch.slice(end))
        if pieces:
            yield from settled(pa.Table.from_batches(pieces))

    return rows.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j").mapInArrow(work, schema)


def _open(tiles: DataFrame, bands: Bands) -> DataFrame:
    """Pairs a < b that bitmaps leave open, as many as would join all that they leave open; and, as a = b, the sets in any open pair.

    No step passes on more than two rows a set.
    """

    def judge(step, bits, arrays):
        parts, found, a, b = Parts(step["component"]), np.zeros(len(bits), bool), [], []
        before = parts.roots()
        for left, right in _open_pairs(step, bits, before, bands):
            found[left] = found[right] = True
            for x, y in zip(left.tolist(), right.tolist(), strict=True) if len(parts.parent) > 1 else ():
                if parts.join(x, y):
                    a.append(step["node"][x])
                    b.append(step["node"][y])
        pair, alone = np.array([a, b], np.int64).reshape(2, -1), step["node"][found]
        return {"a": np.concatenate([pair.min(0), alone]), "b": np.concatenate([pair.max(0), alone])}

    return _in_steps(_blocks(tiles, BLOCK), "a bigint, b bigint", judge)


def overlaps(arrays: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of pairs of different sorted arrays."""
    involved, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    members = np.concatenate([arrays[i] for i in involved])
    if len(left) * 16 < len(involved) ** 2 or len(involved) < 3:
        return np.array([len(np.intersect1d(arrays[x], arrays[y], assume_unique=True)) for x, y in zip(left.tolist(), right.tolist(), strict=True)], np.int64)
    # Many pairs of few sets: a product of membership tables, some members at a time. Sums below 2^24 are exact in float32.
    owner = np.repeat(np.arange(len(involved)), [len(arrays[i]) for i in involved])
    _, column, held_by = np.unique(members, return_inverse=True, return_counts=True)
    shared = held_by[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    total = np.zeros((len(involved), len(involved)), np.int64)
    width = max(1, (32 << 20) // (4 * len(involved)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        table = np.zeros((len(involved), width), np.float32)
        table[owner[a:b], column[a:b] - lo] = 1
        total += (table @ table.T).astype(np.int64)
    return total[place[: len(left)], place[len(left) :]]


def _exact_links(groups: DataFrame, bands: Bands) -> DataFrame:
    """Links (a, b) between the components of each group (as tile), by exact intersection: fewer than a step has sets."""

    def judge(step, bits, arrays):
        parts, a, b = Parts(step["component"]), [], []
        for left, right in _open_pairs(step, bits, parts, bands):
            if len(left):
                both = overlaps(arrays, left, right)
                linked = bands.denominator * both >= bands.numerator * (step["n"][left] + step["n"][right] - both)
                for x, y in zip(left[linked].tolist(), right[linked].tolist(), strict=True):
                    if parts.join(x, y):
                        a.append(step["node"][x])
                        b.append(step["node"][y])
        return {"a": np.minimum(np.array(a, np.int64), b).astype(np.int64), "b": np.maximum(np.array(a, np.int64), b).astype(np.int64)}

    return _in_steps(_blocks(groups, EXACT_BLOCK), "a bigint, b bigint", judge)


def _members(texts: DataFrame, words: int) -> DataFrame:
    """node, n, bits, hashes (the sorted members) of the set of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = shingle_sets(*utf8(batch.column("text")), words)
            marks = pa.array([m.tobytes() for m in bitmaps(hashes, counts)], pa.binary())
            yield pa.RecordBatch.from_pydict({"node": batch.column("doc_id"), "n": counts.astype(np.int64), "bits": marks, "hashes": binary_column(hashes, counts)})

    return texts.mapInArrow(work, "node bigint, n bigint, bits binary, hashes binary")


def _linked(pairs: DataFrame, words: int, bands: Bands) -> DataFrame:
    """The pairs (a, b, text_a, text_b) whose sets are linked, by intersection of sorted arrays."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, n = shingle_sets(*utf8(batch.column("text_a")), words)
            right, m = shingle_sets(*utf8(batch.column("text_b")), words)
            ends, stops = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(m))
            fits = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                overlap = len(np.intersect1d(left[ends[i] : ends[i + 1]], right[stops[i] : stops[i + 1]], assume_unique=True))
                fits[i] = overlap > 0 and bands.denominator * overlap >= bands.numerator * (n[i] + m[i] - overlap)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(fits))

    return pairs.mapInArrow(work, "a bigint, b bigint")


def _written(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read again, so that its true size is known to the planner."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def jaccard_components(docs: DataFrame, words: int = 5, numerator: int = 4, denominator: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; linked when intersection / union >= numerator / denominator."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    bands = Bands(numerator, denominator)
    sets = _written(_sets(docs, words), "sets")
    nodes = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = _written(nodes.groupBy(*NAME).agg(F.min("doc_id").alias("rep")), "classes")
    member = nodes.join(classes, NAME).select("doc_id", "rep", "n_shingles")
    # Rows that share a doc_id but not a set tie their classes together.
    tied = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    links = member.join(tied, "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct()
    links = _written(links, "links")

    of_rep = member.select("doc_id", "rep").distinct()
    tiles = _crowded(_tile_rows(docs, words, bands)).join(of_rep, "doc_id").select("tile", F.col("rep").alias("node")).distinct()
    tiles = _written(_several(tiles, "node"), "tiles")
    marks = nodes.join(classes, NAME).where("doc_id = rep").select(F.col("rep").alias("node"), F.col("n_shingles").alias("n"), F.col("bitmap").alias("bits")).distinct()
    involved = tiles.select(F.col("node").alias("doc_id")).distinct()
    involved = _written(involved, "involved")
    marks = _written(marks.join(involved.withColumnRenamed("doc_id", "node"), "node", "left_semi"), "marks")
    texts = _written(docs.join(involved, "doc_id", "left_semi").distinct(), "texts")

    label = None

    def verified(pairs: DataFrame, links: DataFrame) -> DataFrame:
        read = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        return _written(links.union(_linked(read.select("a", "b", "text_a", "text_b"), words, bands)).distinct(), "links")

    def relabelled(tiles: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Components by the links so far, and the tiles that hold several of them."""
        nodes = tiles.select("node").distinct()
        label = _written(nodes.join(components(links), "node", "left").select("node", F.coalesce("component", "node").alias("component")), "labels")
        return label, _written(_several(tiles.select("tile", "node").join(label, "node"), "component"), "tiles")

    for leaders in LEADERS:
        lead = tiles.groupBy("tile", F.pmod(F.xxhash64("node"), F.lit(leaders)).alias("part")).agg(F.min("node").alias("lead")).select("tile", "lead")
        pairs = tiles.join(lead, "tile").where("node <> lead")
        if label is not None:
            pairs = pairs.join(label.select(F.col("node").alias("lead"), F.col("component").alias("of_lead")), "lead").where("component <> of_lead")
        pairs = pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
        marked = pairs.join(marks.toDF("a", "n_a", "bits_a"), "a").join(marks.toDF("b", "n_b", "bits_b"), "b")
        links = verified(_written(_may_link(marked.select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), bands), "pairs"), links)
        # What has led is compared with its whole tile; tiles within one component are done.
        rest = tiles.select("tile", "node").join(lead.withColumnRenamed("lead", "node"), ["tile", "node"], "left_anti")
        label, tiles = relabelled(rest, links)
    # What is open now is compared by members, each set once: in groups of components that open pairs connect.
    still = _written(_open(tiles.join(marks, "node"), bands).distinct(), "open")
    waiting = still.where("a = b").select(F.col("a").alias("node")).join(label, "node")
    ends = still.where("a < b").join(label.toDF("a", "of_a"), "a").join(label.toDF("b", "of_b"), "b")
    group = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).toDF("component", "tile")
    few = texts.join(waiting.select(F.col("node").alias("doc_id")), "doc_id")
    rest = waiting.join(group, "component").join(_members(few, words), "node")
    links = _written(links.union(_exact_links(rest, bands)).distinct(), "links")

    found = components(links)
    answer = sets.join(classes, NAME, "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep"))
    return answer.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(own, F.col("doc_id"))).alias("component_id"))


def _several(tiles: DataFrame, what: str) -> DataFrame:
    """The rows of tiles that hold different values of `what`."""
    mixed = tiles.groupBy("tile").agg(F.min(what).alias("_low"), F.max(what).alias("_high")).where("_low < _high").select("tile")
    return tiles.join(mixed, "tile", "left_semi")


def drop_near_copies(docs: DataFrame, words: int = 5, numerator: int = 4, denominator: int = 5) -> DataFrame:
    """The rows of `docs`, all columns, with one document (the smallest doc_id) of each component."""
    found = jaccard_components(docs, words, numerator, denominator)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
