"""Fill-in-the-middle forms of whole texts, with token counts from remembered chunks.

A token is white space with the word after it, or white space at the end of a
text, so a token ends where white space follows a word and at the end of the
text. Texts are cut into chunks by a rolling hash of `WINDOW` bytes: a chunk
ends where the hash says so, or after `LONGEST` bytes. What a chunk adds to any
text around it is a boundary summary: whether it begins and ends with white
space, its code points, and the token ends inside it. Chunks that texts share
are summed up once in a task; the memo is keyed by the bytes of the chunk, so
equal names are always equal contents. Summaries of neighbours combine (one
more token ends between a word and white space), running counts give the number
of tokens of a text, and a search in them finds the chunk that holds a cut.

The memo keeps two generations of `MEMO` bytes; what falls out is summed up
again, so its size changes no result. Nothing is shuffled.

Cases: a null text counts as empty and has no tokens. A null doc_id draws like
an empty one. Repeated rows give repeated rows; other columns are not looked at.
An empty table gives no rows. Sentinels must not be parts of one another or
overlap; a text that holds one stays plain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.batches import gather, small_batches, utf8
from strataloom.llm.words import BYTE, ODD, SPACE

WINDOW = 32
MASK_BITS = 8  # a chunk has some 2^8 bytes
LONGEST = 2048
SLICE = 1 << 20  # bytes hashed at a time
MEMO = 16 << 20  # bytes of chunks that one generation of the memo holds

_INVERSE = np.uint64(pow(ODD, -1, 1 << 64))
_UP, _DOWN = np.ones(SLICE + WINDOW, np.uint64), np.ones(SLICE + WINDOW, np.uint64)
np.multiply.accumulate(np.full(SLICE + WINDOW - 1, ODD, np.uint64), out=_UP[1:])
np.multiply.accumulate(np.full(SLICE + WINDOW - 1, _INVERSE, np.uint64), out=_DOWN[1:])


def rolling_cuts(raw: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last WINDOW bytes cuts."""
    found = []
    for at in range(0, len(raw), SLICE):
        begin = max(at - WINDOW, 0)
        part = raw[begin : at + SLICE]
        total = np.cumsum(BYTE[part] * _DOWN[: len(part)], dtype=np.uint64)
        if len(part) > WINDOW:
            hashes = (total[WINDOW:] - total[:-WINDOW]) * _UP[WINDOW : len(part)]
            found.append(np.flatnonzero((hashes >> np.uint64(64 - MASK_BITS)) == 0) + begin + WINDOW + 1)
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def chunk_bounds(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bounds of all chunks; they depend on nothing but the text that a chunk lies in."""
    cuts = rolling_cuts(raw)
    start = bounds[np.searchsorted(bounds, cuts, side="left") - 1]
    cuts = cuts[cuts - start > WINDOW]  # a window never reaches into the text before
    edges = np.unique(np.concatenate([bounds, cuts]))
    lengths = np.diff(edges)
    pieces = -(-lengths // LONGEST)
    inner = gather(np.zeros(len(pieces), np.int64), pieces) * LONGEST
    return np.append(np.repeat(edges[:-1], pieces) + inner, edges[-1:])


class Memo:
    """Boundary summaries by chunk content: begins blank, ends blank, token ends inside, code points, places of the ends."""

    def __init__(self, room: int = MEMO):
        self.room, self.used, self.young, self.old = room, 0, {}, {}
        self.asked = self.summed = 0

    def summaries(self, raw: np.ndarray, edges: np.ndarray) -> list[tuple]:
        data = raw.tobytes()
        places = edges.tolist()
        contents = [data[a:b] for a, b in zip(places, places[1:], strict=False)]
        young, old = self.young, self.old
        new = dict.fromkeys(c for c in contents if c not in young and c not in old)
        self.asked += len(contents)
        self.summed += len(new)
        fresh = dict(zip(new, self._sum_up(list(new)), strict=True))
        answer = [fresh.get(c) or young.get(c) or old[c] for c in contents]
        for c, summary in zip(contents, answer, strict=True):
            if c not in self.young:
                if self.used + len(c) > self.room:
                    self.old, self.young, self.used = self.young, {}, 0
                self.young[c] = summary
                self.used += len(c)
        return answer

    @staticmethod
    def _sum_up(chunks: list[bytes]) -> list[tuple]:
        if not chunks:
            return []
        raw = np.frombuffer(b"".join(chunks), np.uint8)
        ends = np.cumsum([len(c) for c in chunks])
        begins = np.append(0, ends[:-1])
        blank = SPACE[raw]
        stop = np.flatnonzero(np.append(False, blank[1:] & ~blank[:-1]))
        stop = stop[~np.isin(stop, begins)]
        first = np.searchsorted(stop, begins)
        last = np.searchsorted(stop, ends)
        chars = np.add.reduceat((raw & 0xC0) != 0x80, begins, dtype=np.int64)
        inside = (stop - np.repeat(begins, last - first)).astype(np.int32)
        return [
            (h, t, b - a, n, inside[a:b].copy())
            for h, t, a, b, n in zip(blank[begins].tolist(), blank[ends - 1].tolist(), first.tolist(), last.tolist(), chars.tolist(), strict=True)
        ]


class Counted:
    """Tokens of the texts of a batch, and the places where they end."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, memo: Memo):
        self.raw, self.bounds = raw, bounds
        self.edges = chunk_bounds(raw, bounds)
        self.parts = memo.summaries(raw, self.edges)
        m = len(self.parts)
        head, tail, inside, chars = (np.fromiter((p[i] for p in self.parts), np.int64, m) for i in range(4))
        fresh = np.isin(self.edges[:-1], bounds)  # chunks that begin a text
        self.joint = head * np.append(0, 1 - tail[:-1]) * ~fresh if m else np.empty(0, np.int64)
        self.ends = np.append(0, np.cumsum(inside + self.joint))
        self.chars = np.append(0, np.cumsum(chars))
        self.first = np.searchsorted(self.edges, bounds)  # chunk that begins each text
        self.n = np.diff(self.ends[self.first]) + (np.diff(bounds) > 0)

    def cut(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte place and code points before the end of token k[i] of text i; 0 is the beginning of the text."""
        at = np.where(k >= self.n, self.bounds[1:], self.bounds[:-1])
        chars = np.where(k >= self.n, self.chars[self.first[1:]], self.chars[self.first[:-1]])
        for i in np.flatnonzero((k > 0) & (k < self.n)):
            wanted = self.ends[self.first[i]] + k[i]
            c = int(np.searchsorted(self.ends, wanted, side="left")) - 1
            r = int(wanted - self.ends[c]) - int(self.joint[c])
            place = self.edges[c] + (self.parts[c][4][r - 1] if r else 0)
            at[i], chars[i] = place, self.chars[c] + np.count_nonzero((self.raw[self.edges[c] : place] & 0xC0) != 0x80)
        return at - self.bounds[:-1], chars - self.chars[self.first[:-1]]


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row.

    Draws h1..h4 are the first four groups of eight digits of the SHA-256 of
    `seed:doc_id`; the cuts are h1 and h2 modulo n + 1. Of 100 texts without
    sentinels `rate` are cut, and of 100 cut ones `spm` put the suffix first.
    """
    small_batches(docs.sparkSession)
    p, s, m = (x.encode() for x in sentinels)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = (text == "") | (h[2] % 100 >= rate)
    for mark in sentinels:
        plain = plain | text.contains(mark)
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, bounds = utf8(batch.column("text"))
            counted = Counted(raw, bounds, memo)
            h1, h2 = (np.asarray(batch.column(c)) % (counted.n + 1) for c in ("h1", "h2"))
            forms = batch.column("form").to_pylist()
            (left, chars), (right, chars_to) = counted.cut(np.minimum(h1, h2)), counted.cut(np.maximum(h1, h2))
            data, out = raw.tobytes(), []
            for i, (kind, a, b) in enumerate(zip(forms, left.tolist(), right.tolist(), strict=True)):
                whole = data[bounds[i] : bounds[i + 1]]
                if kind == "psm":
                    whole = b"".join([p, whole[:a], s, whole[b:], m, whole[a:b]])
                elif kind == "spm":
                    whole = b"".join([s, whole[b:], p, whole[:a], m, whole[a:b]])
                out.append(whole)
            none = np.array([kind == "plain" for kind in forms])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": counted.n.astype(np.int64), "form": batch.column("form"),
                "prefix_chars": pa.array(chars, pa.int64(), mask=none), "middle_chars": pa.array(chars_to - chars, pa.int64(), mask=none),
                "output": pa.array(out, pa.binary()).cast(pa.string()),
            })

    drawn = docs.select("doc_id", "text", h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))
    return drawn.mapInArrow(work, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that an output of `fill_in_middle` was made from."""
    p, s, m = sentinels
    middle = F.substring_index(output, m, -1)

    def between(after: str, before: str) -> Column:
        return F.substring_index(F.substring_index(output, after, -1), before, 1)

    return (
        F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
        .when(form == "spm", F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )
