"""Document fingerprints by locally consistent parsing.

A text is a string of bytes. In each round runs of one symbol become one
symbol, then deterministic coin tossing deals labels: a symbol's label is the
lowest bit in which it differs from the symbol before, and that bit's value;
four rounds of it leave six labels, three more steps leave three, and local
maxima of these begin a phrase of two to five symbols. Phrases are named by a
hash of their symbols and are the symbols of the next level. Where a phrase
ends depends on a few neighbours only, so equal substrings get the same phrases
at every level but for a few at their ends, wherever they stand in a text.

The fingerprint is the name of the whole text and, for the first level and the
two coarsest that have `KEPT` phrases, the `KEPT` smallest 24-bit names of
(phrase, how often it came before). The likeness of two fingerprints is the
share of common phrases among all of both (Jaccard, repeats counted) on their
coarsest common level, but for equal names exact if both hold all their
phrases, otherwise estimated from the smallest names.

`with_next` reads documents in the order of doc_id (null first, ties by a hash
of the text). Keys alone are sampled for bounds; then every text moves once, to
the range it belongs to, and each range is read as a stream. What the last
document of a range needs from the first of the next one comes by a join of one
row per range.

Cases: a null text counts as empty; empty texts have a fingerprint of their own
without phrases and are like each other. The last document's next is the first,
a single document's next is itself. Repeated rows give repeated rows; other
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.batches import small_batches, utf8
from strataloom.llm.words import BYTE, ODD, mix
from strataloom.session import cut_lineage

KEPT = 64
TOGETHER = 200  # texts parsed in one go
DEEPEST = 12  # levels looked at for phrases; names go on to the whole text
LONGEST_PHRASE = 5
_COEFFICIENTS = np.array([pow(ODD, 2 * i + 1, 1 << 64) for i in range(LONGEST_PHRASE)], np.uint64)
_RUN = np.uint64(0xD6E8FEB86659FD93)


def _label(symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Lowest bit in which neighbours differ, and the symbol's value there."""
    differ = symbol ^ before
    low = differ & (~differ + differ.dtype.type(1))
    return (2 * np.bitwise_count(low - differ.dtype.type(1)) + ((symbol & low) != 0)).astype(np.uint8)


def _free(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest of 0, 1, 2 that neither neighbour has."""
    return np.where((left != 0) & (right != 0), 0, np.where((left != 1) & (right != 1), 1, 2)).astype(np.uint8)


def _neighbours(labels: np.ndarray, first: np.ndarray, last: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = np.empty_like(labels), np.empty_like(labels)
    left[1:], right[:-1] = labels[:-1], labels[1:]
    left[first], right[last] = none, none
    return left, right


def _squeezed(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of one symbol as one symbol."""
    begins = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])))
    length = np.diff(np.append(begins, len(names)))
    symbols = names[begins]
    runs = np.flatnonzero(length > 1)
    symbols[runs] = mix(symbols[runs] * _RUN + length[runs].astype(np.uint64))
    return symbols, owner[begins]


def _phrases(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and texts of the next level; no two neighbours of a text are equal."""
    first = np.append(True, owner[1:] != owner[:-1])
    last = np.append(first[1:], True)
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[first] = names[first] ^ np.uint64(1)
    labels = _label(names, before)
    for _ in range(3):
        left = np.empty_like(labels)
        left[1:] = labels[:-1]
        left[first] = labels[first] ^ 1
        labels = _label(labels, left)
    for high in (3, 4, 5):
        left, right = _neighbours(labels, first, last, 7)
        labels = np.where(labels == high, _free(left, right), labels)
    left, right = _neighbours(labels, first, last, 3)
    begins = np.flatnonzero(first | ((labels > left) & (labels > right)))
    length = np.diff(np.append(begins, len(names)))
    total = names[begins] * _COEFFICIENTS[0] + length.astype(np.uint64) * _RUN
    for i in range(1, LONGEST_PHRASE):
        longer = np.flatnonzero(length > i)
        total[longer] += names[begins[longer] + i] * _COEFFICIENTS[i]
    return mix(total), owner[begins]


def levels(raw: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrase names and the text of each phrase, level by level; a text is done when it is one phrase."""
    names, owner = BYTE[raw], np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    while len(names):
        names, owner = _phrases(*_squeezed(names, owner))
        yield names, owner
        more = np.append(False, owner[1:] == owner[:-1])
        more[:-1] |= more[1:]
        names, owner = names[more], owner[more]


class Fingerprint:
    """Name of the whole text, and the smallest phrase names of its levels."""

    __slots__ = ("levels", "name")

    def __init__(self, name: int, kept: dict[int, list[int]]):
        self.name, self.levels = name, kept

    def __str__(self) -> str:
        return f"{self.name:016x}" + "".join(f".{k}:{''.join([f'{x:06x}' for x in v])}" for k, v in sorted(self.levels.items()))

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        name, *parts = text.split(".")
        kept = {}
        for part in parts:
            level, names = part.split(":")
            kept[int(level)] = [int(names[i : i + 6], 16) for i in range(0, len(names), 6)]
        return cls(int(name, 16), kept)

    def likeness(self, other: Fingerprint) -> float:
        if self.name == other.name:
            return 1.0
        common = self.levels.keys() & other.levels.keys()
        if not common:
            return 0.0
        a, b = self.levels[max(common)], other.levels[max(common)]
        union = sorted({*a, *b})
        if len(a) >= KEPT or len(b) >= KEPT:
            union = union[:KEPT]
        return len({*a} & {*b} & {*union}) / len(union)


def _numbered(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and 24-bit name of each different (phrase, how often the text had it before), by text and name."""
    text = owner.astype(np.uint64)
    key = np.sort((text << np.uint64(44)) | (names >> np.uint64(20)))
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    before = np.arange(len(key)) - np.repeat(begins, np.diff(np.append(begins, len(key))))
    name = mix((key & np.uint64((1 << 44) - 1)) + before.astype(np.uint64) * np.uint64(ODD)) >> np.uint64(40)
    found = np.sort((key >> np.uint64(44) << np.uint64(24)) | name)
    found = found[np.append(True, found[1:] != found[:-1])]
    return (found >> np.uint64(24)).astype(np.int64), found & np.uint64((1 << 24) - 1)


def fingerprints(raw: np.ndarray, bounds: np.ndarray) -> list[Fingerprint]:
    """The fingerprint of every text (bytes one after the other, n + 1 bounds)."""
    n = len(bounds) - 1
    roots, chosen = [0] * n, [{} for _ in range(n)]
    for depth, (names, owner) in enumerate(levels(raw, bounds), 1):
        phrases = np.bincount(owner, minlength=n)
        single = phrases[owner] == 1
        for i, name in zip(owner[single].tolist(), names[single].tolist(), strict=True):
            roots[i] = name
        if depth > DEEPEST:
            continue
        of, values = _numbered(names, owner)
        counts = np.bincount(of, minlength=n)
        ends = np.cumsum(counts)
        for i in np.flatnonzero((counts >= KEPT) | (counts > 0) & (depth == 1)).tolist():
            if depth > 3:
                chosen[i].pop(depth - 2, None)
            chosen[i][depth] = values[ends[i] - counts[i] : ends[i] - counts[i] + min(KEPT, counts[i])].tolist()
    return [Fingerprint(r, c) for r, c in zip(roots, chosen, strict=True)]


def fingerprints_of(texts: list[str]) -> list[Fingerprint]:
    """Fingerprints of many texts, a few at a time so that the arrays of a parse stay small."""
    found = []
    for at in range(0, len(texts), TOGETHER):
        found += fingerprints(*utf8(pa.array(texts[at : at + TOGETHER], pa.large_string())))
    return found


def edited(text: str, following: str) -> str:
    """`text` with its last quarter of code points replaced by as many (or all) of the next text's first."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row, without any shuffle."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [str(f) for f in fingerprints_of([t or "" for t in batch.column("text").to_pylist()])]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fingerprint": pa.array(found, pa.string())})

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id bigint, fingerprint string")


SCHEMA = "doc_id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str], following: list[str], own: list[Fingerprint], after: list[Fingerprint]) -> pa.RecordBatch:
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    other = fingerprints_of(changed)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()), "edited": pa.array(changed, pa.string()),
        "fingerprint": pa.array([str(f) for f in own], pa.string()), "edited_fingerprint": pa.array([str(f) for f in other], pa.string()),
        "near_edited": pa.array([a.likeness(b) for a, b in zip(own, other, strict=True)], pa.float64()),
        "near_next": pa.array([a.likeness(b) for a, b in zip(own, after, strict=True)], pa.float64()),
    })


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All documents of a sorted range but the last, each with the one after it."""
    ids, texts, own = [], [], []
    for batch in batches:
        more = [t or "" for t in batch.column("text").to_pylist()]
        ids, texts, own = ids + batch.column("doc_id").to_pylist(), texts + more, own + fingerprints_of(more)
        if len(ids) > 1:
            yield _rows(ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:])
        ids, texts, own = ids[-1:], texts[-1:], own[-1:]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents beside the text after them."""
    for batch in batches:
        texts, following = ([t or "" for t in batch.column(c).to_pylist()] for c in ("text", "following"))
        yield _rows(batch.column("doc_id").to_pylist(), texts, following, fingerprints_of(texts), fingerprints_of(following))


def _range_of(key: list[Column], bounds: list[tuple]) -> Column:
    """How many of the sorted bounds are not above the key, by binary search in literal arrays."""
    if not bounds:
        return F.lit(0)
    parts = [F.array(*[F.lit(int(v)).cast("bigint") for v in column]) for column in zip(*bounds, strict=True)]

    def reached(i: Column) -> Column:
        at = [F.get(p, i) for p in parts]
        below = at[-1] <= key[-1]
        for a, k in zip(at[-2::-1], key[-2::-1], strict=True):
            below = (a < k) | ((a == k) & below)
        return below

    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & reached(at + step - 1), at + step).otherwise(at))


def with_next(docs: DataFrame) -> DataFrame:
    """Every row with its fingerprint, its text edited towards the next document's, and their likenesses (SCHEMA)."""
    spark = docs.sparkSession
    small_batches(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # _r tells repeated rows apart, so that very many of them can be dealt to several ranges.
    id_, text = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))), F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), id_.alias("_k"), F.xxhash64(text).alias("_h")).withColumn("_r", F.monotonically_increasing_id())
    keys = cut_lineage(rows.select("_k", "_h", "_r"))
    key = F.struct("_k", "_h", "_r")
    dealt = keys.repartitionByRange(ranges, "_k", "_h", "_r")
    lows = sorted(tuple(r[0]) for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("low")).select("low").collect())
    if not lows:
        return spark.createDataFrame([], SCHEMA)
    place = _range_of([F.col("_k"), F.col("_h"), F.col("_r")], lows[1:]).alias("_range")

    # One first and one last key of each range; ranges that a bound left empty do not occur.
    ends = keys.groupBy(place).agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy("_range").select("low", "high").collect()
    follows = [(*high[:2], *low[:2]) for (_, high), (low, _) in zip(ends, [*ends[1:], ends[0]], strict=True)]
    pairs = spark.createDataFrame(follows, "_k bigint, _h bigint, _nk bigint, _nh bigint")
    wanted = pairs.select("_k", "_h").union(pairs.select("_nk", "_nh")).distinct()
    texts = rows.join(F.broadcast(wanted), ["_k", "_h"], "left_semi").dropDuplicates(["_k", "_h"]).select("_k", "_h", "doc_id", "text")
    texts = cut_lineage(texts)
    edge = pairs.join(texts, ["_k", "_h"]).join(texts.select(F.col("_k").alias("_nk"), F.col("_h").alias("_nh"), F.col("text").alias("following")), ["_nk", "_nh"])

    ranged = rows.withColumn("_range", place).repartitionById(ranges, F.col("_range")).sortWithinPartitions("_range", "_k", "_h", "_r")
    inside = ranged.select("doc_id", "text").mapInArrow(_inside, SCHEMA)
    return inside.unionByName(edge.select("doc_id", "text", "following").mapInArrow(_edges, SCHEMA))
