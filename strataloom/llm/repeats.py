"""Removal of repeated byte strings: every byte covered by a string of `LENGTH` bytes that also starts earlier.

Suffixes are only compared where a match is possible. Every window of LENGTH
bytes has an anchor, the smallest hashed GRAM-byte string in it (the leftmost
of equal ones), so equal windows have equal anchors at the same offset. The
windows of one anchor are consecutive and cover one context. Contexts that are
equal as a whole (64-bit hashes of anchor and context) match in all their
windows: within a batch and then by anchor, only the earliest goes on. Where an
anchor still has different contexts, its windows go on in groups that agree on
all but the outermost SPREAD - 1 bytes. An anchor with more than HOT waiting
contexts would make such groups without bound, so its windows go on one by one,
named by a hash of all their bytes; of equal ones a batch sends only the
earliest. Only the names of the groups meet at first; the bytes of a window are
sent where another one has its name. There the suffixes are sorted, and the longest previous factor of a suffix reaches LENGTH exactly
if, among its neighbours in suffix order with a common prefix of LENGTH, the
previous or the next smaller position exists. Texts equal as a whole are
resolved beforehand, as their later copies are removed from end to end.

The order of starts is (doc_id, start). Strings are judged on the input, and
matches do not cross documents.

Cases: a null text is empty. Texts shorter than LENGTH keep all bytes. Null
doc_ids (and the largest bigint) come after all others. Rows of equal doc_id
are one document: equal starts are not earlier than one another, so repeated
rows are judged alike. An empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.batches import binary_column, gather, packed, small_batches, unpacked, utf8
from strataloom.llm.words import BYTE, ODD, mix, powers

LENGTH, GRAM, SPREAD = 100, 24, 16
HOT = 4096  # waiting contexts of one anchor that are compared as one group
ITEMS = 2048  # contexts of hot anchors looked at in one go
PIECE = 1 << 20  # window starts looked at in one go
RUNS = 1 << 13  # runs sent on as bytes in one go
NO_ID = (1 << 63) - 1
INVERSE = pow(ODD, -1, 1 << 64)
MASK = (1 << 64) - 1

ROWS = "kind int, gram bigint, context bigint, doc bigint, variant bigint, first int, n int, offset int"
CORES = "core bigint, doc bigint, variant bigint, first bigint, n bigint, settled boolean"
REMOVED, WAITS, WAITS_HOT = 0, 1, 2


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first start in it, number, offset of the anchor, anchor hash, context hash."""
    out: list[tuple[np.ndarray, ...]] = []
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    last = np.repeat(bounds[1:], np.diff(bounds)) - length  # last start of a window in the same text
    width = length - gram + 1
    for a in range(0, max(len(raw) - length + 1, 0), PIECE):
        part = BYTE[raw[a : a + PIECE + length - 1]]
        size, total = 1, part
        powers_of = {1: part}
        while size * 2 <= gram:
            total = total[:-size] * np.uint64(pow(ODD, size, MASK + 1)) + total[size:]
            size *= 2
            powers_of[size] = total
        at = size
        for more in sorted(powers_of, reverse=True):  # gram as a sum of powers of two
            if at + more <= gram:
                n = len(part) - at - more + 1
                total = total[:n] * np.uint64(pow(ODD, more, MASK + 1)) + powers_of[more][at : at + n]
                at += more
        hashed = mix(total)
        low = (hashed & ~np.uint64((1 << 22) - 1)) | np.arange(len(hashed), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
        start = np.flatnonzero(np.arange(a, a + len(low)) <= last[a : a + len(low)])
        if not len(start):
            continue
        anchor = (low[start] & np.uint64((1 << 22) - 1)).astype(np.int64)
        begin = np.flatnonzero(np.append(True, (np.diff(start) != 1) | (anchor[1:] != anchor[:-1]) | (text[a + start[1:]] != text[a + start[:-1]])))
        first, n = start[begin], np.diff(np.append(begin, len(start)))
        power = powers(len(part))
        summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * power)])
        context = (summed[first + n - 1 + length] - summed[first]) * inverse_powers(len(part))[first]
        offset = anchor[begin] - first
        context = mix(mix(context) + n.astype(np.uint64) * np.uint64(ODD) + offset.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        of = text[a + first]
        out.append((of, a + first - bounds[of], n, offset, hashed[anchor[begin]], context))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


_inverse = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    """The first n powers of the inverse of ODD modulo 2^64."""
    global _inverse
    while len(_inverse) < n:
        _inverse = np.concatenate([_inverse, _inverse * np.uint64(pow(INVERSE, len(_inverse), MASK + 1))])
    return _inverse[:n]


def settle(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by anchor, context and start, and which rows in that order have an earlier equal context."""
    by = np.lexsort((rows["variant"], rows["first"], rows["doc"], rows["context"], rows["gram"]))
    gram, context, doc, first = (rows[c][by] for c in ("gram", "context", "doc", "first"))
    new = np.append(True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]))[: len(by)]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return by, (doc != doc[head]) | (first != first[head])


def _batch(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    names = [c.split()[0] for c in ROWS.split(", ")]
    kinds = {c.split()[0]: pa.int32() if c.split()[1] == "int" else pa.int64() for c in ROWS.split(", ")}
    return pa.RecordBatch.from_pydict({c: pa.array(rows[c].view(np.int64) if rows[c].dtype == np.uint64 else rows[c]).cast(kinds[c]) for c in names})


def _find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """ROWS of all anchors; copies met within a batch are settled at once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches, "text"):
            of, first, n, offset, gram, context = anchors(*utf8(batch.column("text")), length, GRAM)
            doc, variant = batch.column("doc").to_numpy()[of], batch.column("variant").to_numpy()[of]
            rows = {"gram": gram.view(np.int64), "context": context.view(np.int64), "doc": doc, "variant": variant, "first": first, "n": n, "offset": offset}
            by, later = settle(rows)
            rows = {k: v[by] for k, v in rows.items()}
            yield _batch({k: v[~later] for k, v in rows.items()} | {"kind": np.full((~later).sum(), WAITS)})
            yield _batch(joined({k: v[later] for k, v in rows.items()}))

    return docs.mapInArrow(work, ROWS)


def joined(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Settled rows as few long runs; they need no anchor any more and are dealt by document."""
    by = np.lexsort((rows["first"], rows["variant"], rows["doc"]))
    doc, variant, first, n = (rows[c][by] for c in ("doc", "variant", "first", "n"))
    begin = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (variant[1:] != variant[:-1]) | (first[1:] != first[:-1] + n[:-1]))[: len(by)])
    none = np.zeros(len(begin), np.int64)
    length = np.add.reduceat(n, begin) if len(begin) else none
    return {"kind": none, "gram": doc[begin], "context": none, "doc": doc[begin], "variant": variant[begin], "first": first[begin], "n": length, "offset": none}


def _meet(rows: DataFrame, hot: int) -> DataFrame:
    """Settle equal contexts of each anchor; those of anchors left with different contexts wait.

    The sorted rows stream by; only the earliest rows of the last context are
    held back, until it is known whether its anchor has another context. Up to
    `hot` waiting rows of the last anchor are held back too, until it is known
    whether there are more.
    """
    names = [c.split()[0] for c in ROWS.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: np.empty(0, np.int64) for c in names}
        others = False  # whether the anchor of the held rows has shown another context
        pending = held  # waiting rows of the last anchor, at most `hot`
        hot_gram: int | None = None  # the last anchor, if it is known to be hot

        def waiting(rows: dict[str, np.ndarray], last: int | None) -> pa.RecordBatch:
            """The pending and the given rows but those of anchor `last`, unless it is hot; these are pending now."""
            nonlocal pending, hot_gram
            rows = {c: np.concatenate([pending[c], v]) for c, v in rows.items()}
            gram, of, count = np.unique(rows["gram"], return_inverse=True, return_counts=True)
            many = count > hot
            if hot_gram is not None:
                many |= gram == hot_gram
            stay = ~many & (gram == last) if last is not None else np.zeros(len(gram), bool)
            if last != hot_gram:
                hot_gram = last if last is not None and many[gram == last].any() else None
            pending = {c: v[stay[of]] for c, v in rows.items()}
            return _batch({c: v[~stay[of]] for c, v in rows.items()} | {"kind": np.where(many[of], WAITS_HOT, WAITS)[~stay[of]]})

        for batch in batches:
            rows = {c: np.asarray(batch.column(c)) for c in names}
            known = rows["kind"] == REMOVED
            if known.any():
                yield _batch({c: v[known] for c, v in rows.items()})
            rows = {c: np.concatenate([held[c], v[~known]]) for c, v in rows.items()}
            if not len(rows["gram"]):
                continue
            by, later = settle(rows)
            rows = {c: v[by] for c, v in rows.items()}
            new_gram = np.append(True, rows["gram"][1:] != rows["gram"][:-1])
            new_context = new_gram | np.append(True, rows["context"][1:] != rows["context"][:-1])
            group = np.cumsum(new_gram) - 1
            several = np.bincount(group, new_context) > 1
            several[0] |= others
            last = np.cumsum(new_context) == new_context.sum()
            repeated = np.append(False, np.all([rows[c][1:] == rows[c][:-1] for c in ("gram", "context", "doc", "first", "variant")], axis=0))
            held = {c: v[last & ~later & ~repeated] for c, v in rows.items()}
            others = bool(several[-1])
            yield _batch({c: v[later] for c, v in rows.items()} | {"kind": np.full(later.sum(), REMOVED)})
            waits = several[group] & ~last & ~repeated & ~later
            yield waiting({c: v[waits] for c, v in rows.items()}, int(rows["gram"][-1]))
        yield waiting({c: v if others else v[:0] for c, v in held.items()}, None)

    return rows.mapInArrow(work, ROWS)


def _cores(docs: DataFrame, length: int) -> DataFrame:
    """The waiting windows of each document in runs of at most SPREAD, named by `core`.

    `core` names the bytes that all windows of a full run share; equal windows
    have equal cores, as the run follows from the offset of the anchor. Windows of
    hot anchors are runs of their own with all their bytes as core; those with an
    earlier equal one in the batch come as settled runs.
    """
    share = length - SPREAD + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches, "text"):
            raw, bounds = utf8(batch.column("text"))
            waits = batch.column("waits")
            count = np.diff(np.asarray(waits.offsets))
            doc = np.repeat(np.arange(batch.num_rows), count)
            items = waits.flatten()
            first, n, offset = (np.asarray(items.field(c)).astype(np.int64) for c in ("first", "n", "offset"))
            hot = items.field("hot").to_numpy(zero_copy_only=False).astype(bool)
            at = np.flatnonzero(hot)
            for a in range(0, len(at), ITEMS):
                use = at[a : a + ITEMS]
                yield from _hot_windows(batch, raw, bounds, doc[use], first[use], n[use], length)
            doc, first, n, offset = doc[~hot], first[~hot], n[~hot], offset[~hot]
            gram = np.asarray(items.field("gram")).view(np.uint64)[~hot]
            anchor = bounds[doc] + first + offset
            for run in range(int(offset.max()) // SPREAD + 1 if len(offset) else 0):
                # windows whose anchor lies run * SPREAD .. run * SPREAD + SPREAD - 1 bytes after their start
                from_ = np.maximum(offset - n + 1, run * SPREAD)
                to = np.minimum(offset, run * SPREAD + SPREAD - 1)
                begin = anchor - to
                core_at = anchor - run * SPREAD
                use = np.flatnonzero(from_ <= to)
                if not len(use):
                    continue
                core_at = core_at[use]
                core = _hash_runs(raw, core_at, share)
                core = mix(core + mix(gram[use] + np.uint64(run)))
                owner = doc[use]
                yield pa.RecordBatch.from_pydict({
                    "core": core.view(np.int64), "doc": batch.column("doc").take(pa.array(owner)), "variant": batch.column("variant").take(pa.array(owner)),
                    "first": pa.array(begin[use] - bounds[owner]), "n": pa.array((to - from_ + 1)[use]), "settled": pa.array(np.zeros(len(use), bool)),
                })

    return docs.mapInArrow(work, CORES)


def _hot_windows(batch: pa.RecordBatch, raw: np.ndarray, bounds: np.ndarray, doc: np.ndarray, first: np.ndarray, n: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """The windows of hot anchors as runs of one window: the earliest of equal ones, and settled runs of the others."""
    row, at = np.repeat(np.arange(len(n)), n), gather(first, n)
    place = bounds[doc[row]] + at
    hashed = _hash_runs(raw, place, length)
    owner, variant = (batch.column(c).to_numpy()[doc[row]] for c in ("doc", "variant"))
    by = np.lexsort((variant, at, owner, hashed))
    at, place, hashed, owner, variant = (x[by] for x in (at, place, hashed, owner, variant))
    windows = np.lib.stride_tricks.sliding_window_view(raw, length)[place]
    same = np.append(False, (hashed[1:] == hashed[:-1]) & (windows[1:] == windows[:-1]).all(1))  # equal hashes count only with equal bytes
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
    later = (owner != owner[head]) | (at != at[head])
    runs = joined({"doc": owner[later], "variant": variant[later], "first": at[later], "n": np.ones(later.sum(), np.int64)})
    runs = {c: runs[c] for c in ("doc", "variant", "first", "n")}
    yield pa.RecordBatch.from_pydict({"core": mix(runs["doc"].astype(np.uint64)).view(np.int64), **runs, "settled": np.ones(len(runs["n"]), bool)})
    keep = ~later
    yield pa.RecordBatch.from_pydict({
        "core": mix(hashed[keep] + np.uint64(ODD)).view(np.int64), "doc": owner[keep], "variant": variant[keep],
        "first": at[keep], "n": np.ones(keep.sum(), np.int64), "settled": np.zeros(keep.sum(), bool),
    })


def _shared(cores: DataFrame) -> DataFrame:
    """The settled runs, and those whose core another run has too; repeated rows come once. Sorted by core, the rows stream by."""
    names = [c.split()[0] for c in CORES.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = {c: np.empty(0, bool if c == "settled" else np.int64) for c in names}, False  # the last row, and whether one before it has its core
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: np.concatenate([held[c], batch.column(c).to_numpy(zero_copy_only=False)]) for c in names}
            new = np.append(True, ~np.all([v[1:] == v[:-1] for v in rows.values()], axis=0))
            rows = {c: v[new] for c, v in rows.items()}
            same = rows["core"][1:] == rows["core"][:-1]
            before = np.append(known, same)
            keep = before[:-1] | same | rows["settled"][:-1]
            yield pa.RecordBatch.from_pydict({c: v[:-1][keep] for c, v in rows.items()})
            held, known = {c: v[-1:] for c, v in rows.items()}, bool(before[-1])
        if len(held["core"]) and (known or held["settled"][0]):
            yield pa.RecordBatch.from_pydict(held)

    return cores.repartition("core").sortWithinPartitions("core", "settled", "doc", "variant", "first", "n").mapInArrow(work, CORES)


def _pieces(docs: DataFrame, length: int) -> DataFrame:
    """The wanted runs of each document with the bytes of their windows; settled ones come without bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches, "text"):
            raw, bounds = utf8(batch.column("text"))
            wanted = batch.column("wanted")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(wanted.offsets)))
            items = wanted.flatten()
            core, first, n = (np.asarray(items.field(c)) for c in ("core", "first", "n"))
            settled = items.field("settled").to_numpy(zero_copy_only=False).astype(bool)
            for a in range(0, len(owner), RUNS):
                use = slice(a, a + RUNS)
                of, size = owner[use], np.where(settled[use], 0, n[use] + length - 1)
                data = binary_column(raw[gather(bounds[of] + first[use], size)], size)
                yield pa.RecordBatch.from_pydict({
                    "core": core[use], "doc": batch.column("doc").take(pa.array(of)), "variant": batch.column("variant").take(pa.array(of)),
                    "first": first[use], "n": n[use], "bytes": pc.if_else(pa.array(settled[use]), pa.scalar(None, pa.binary()), data),
                })

    return docs.mapInArrow(work, "core bigint, doc bigint, variant bigint, first bigint, n bigint, bytes binary")


def _hash_runs(raw: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` bytes from each start."""
    total = np.zeros(len(starts), np.uint64)
    for i in range(size):
        total = total * np.uint64(ODD) + BYTE[raw[starts + i]]
    return mix(total)


def has_earlier(suffixes: np.ndarray, group: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each suffix reaches its whole given prefix.

    `suffixes` has one row of prefix bytes per suffix; suffixes of different
    groups do not match. Sorted in suffix order, those with a common prefix of
    full length lie together, and the longest previous factor reaches it if
    the previous or the next smaller position lies in the same stretch.
    """
    count, length = suffixes.shape
    if not count:
        return np.empty(0, bool)
    padded = np.zeros((count, -(-length // 8) * 8), np.uint8)
    padded[:, :length] = suffixes
    words = padded.view(">u8").astype(np.uint64)
    by = np.lexsort([*(words[:, i] for i in range(words.shape[1] - 1, -1, -1)), group])
    words, place = words[by], position[by].astype(np.int64)
    full = (group[by][1:] == group[by][:-1]) & (words[1:] == words[:-1]).all(1)  # common prefix with the one before
    stretch = np.cumsum(np.append(True, ~full))
    apart = stretch * (int(place.max()) + 1)
    previous = np.minimum.accumulate(place - apart) + apart < place
    back = stretch.max() - stretch
    apart = back * (int(place.max()) + 1)
    following = (np.minimum.accumulate((place - apart)[::-1])[::-1] + apart) < place
    out = np.empty(count, bool)
    out[by] = previous | following
    return out


def _compare(pieces: DataFrame, length: int) -> DataFrame:
    """Runs of starts (doc, variant, first, n) whose windows start earlier too, from pieces in order of core."""
    names = ["core", "doc", "variant", "first", "n"]

    def judge(rows: dict[str, np.ndarray], raw: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch | None:
        core = rows["core"]
        new = np.append(True, core[1:] != core[:-1])
        group = np.cumsum(new) - 1
        use = np.flatnonzero(np.bincount(group)[group] > 1)
        n = rows["n"][use]
        if not len(use):
            return None
        row = np.repeat(use, n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        start = rows["first"][row] + step
        windows = np.lib.stride_tricks.sliding_window_view(raw, length)[bounds[row] + step]
        by = np.lexsort((start, rows["doc"][row]))
        position = np.empty(len(by), np.int64)
        position[by] = np.cumsum(np.append(0, (rows["doc"][row][by][1:] != rows["doc"][row][by][:-1]) | (start[by][1:] != start[by][:-1])))
        hit = np.flatnonzero(has_earlier(windows, group[row], position))
        if not len(hit):
            return None
        begin = np.flatnonzero(np.append(True, (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])))
        size = np.diff(np.append(begin, len(hit)))
        at = hit[begin]
        return pa.RecordBatch.from_pydict({"doc": rows["doc"][row[at]], "variant": rows["variant"][row[at]], "first": start[at], "n": size})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {c: np.empty(0, np.int64) for c in names}
        held_raw, held_size = np.empty(0, np.uint8), np.empty(0, np.int64)
        for batch in batches:
            settled = batch.column("bytes").is_null()
            yield batch.filter(settled).select(["doc", "variant", "first", "n"])
            batch = batch.filter(pc.invert(settled))
            rows = {c: np.concatenate([held[c], np.asarray(batch.column(c))]) for c in names}
            raw, bounds = utf8(batch.column("bytes"))
            raw, size = np.concatenate([held_raw, raw]), np.concatenate([held_size, np.diff(bounds)])
            bounds = np.append(0, np.cumsum(size))
            whole = int(np.searchsorted(rows["core"], rows["core"][-1])) if len(size) else 0  # the last core may go on
            found = judge({c: v[:whole] for c, v in rows.items()}, raw, bounds)
            if found is not None:
                yield found
            held, held_raw, held_size = {c: v[whole:] for c, v in rows.items()}, raw[bounds[whole] :], size[whole:]
        found = judge(held, held_raw, np.append(0, np.cumsum(held_size)))
        if found is not None:
            yield found

    return pieces.mapInArrow(work, "doc bigint, variant bigint, first bigint, n bigint")


def cover(raw: np.ndarray, bounds: np.ndarray, runs: pa.Array, copy: pa.Array, length: int) -> np.ndarray:
    """Which bytes of the texts are covered by the runs of starts, or belong to a later copy of a whole text."""
    size = np.diff(bounds)
    count = np.diff(np.asarray(runs.offsets)) if len(runs) else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(size)), count)
    items = runs.flatten()
    first, n = (np.asarray(items.field(c)).astype(np.int64) for c in ("first", "n"))
    change = np.zeros(len(raw) + 1, np.int32)
    np.add.at(change, bounds[doc] + first, 1)
    np.add.at(change, bounds[doc] + first + n - 1 + length, -1)
    covered = np.cumsum(change[:-1]) > 0
    copies = np.flatnonzero(np.asarray(copy) & (size >= length))
    covered[gather(bounds[copies], size[copies])] = True
    return covered


def _measure(marked: DataFrame, length: int) -> DataFrame:
    """Cut the covered bytes out of every text and count them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches, "text"):
            raw, bounds = utf8(batch.column("text"))
            size = np.diff(bounds)
            covered = cover(raw, bounds, batch.column("runs"), batch.column("copy"), length)
            removed = np.diff(np.append(0, np.cumsum(covered))[bounds])
            starts = covered & np.append(True, ~covered[:-1])[: len(covered)]
            starts[bounds[:-1][size > 0]] = covered[bounds[:-1][size > 0]]  # a run does not go on from the text before
            spans = np.diff(np.append(0, np.cumsum(starts))[bounds])
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc"), "n_bytes": size, "n_removed": removed, "n_spans": spans, "kept": binary_column(raw[~covered], size - removed)})

    return marked.mapInArrow(work, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def _keyed(docs: DataFrame) -> DataFrame:
    """`docs` with the order key `doc`, the text without null, and `text_hash`."""
    return docs.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_hash", F.xxhash64("text"))


def _firsts(texts: DataFrame) -> DataFrame:
    """The first document of each text: first_doc, hash, and `variant`, which tells apart the texts of one doc_id (else 0)."""
    first = texts.groupBy("text_hash").agg(F.min("doc").alias("doc"))
    several = texts.groupBy("doc").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).where("low < high").select("doc", F.lit(True).alias("several"))
    marked = first.join(several, "doc", "left")
    return marked.select(F.col("doc").alias("first_doc"), F.col("text_hash").alias("hash"), F.when(F.col("several"), F.col("text_hash")).otherwise(0).alias("variant"))


# All joins of the texts go by doc alone, so that they share one exchange of the packed texts; which of
# several texts of one doc_id is meant is left to a condition that is no equality of two columns.
def _same_text() -> Column:
    return (F.col("doc") == F.col("first_doc")) & (F.col("text_hash").bitwiseXOR(F.col("hash")) == 0)


def _of_variant() -> Column:
    return (F.col("doc") == F.col("of_doc")) & ((F.col("of_variant") == 0) | (F.col("of_variant").bitwiseXOR(F.col("text_hash")) == 0))


def _dealt(texts: DataFrame, firsts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """What `_meet` settles or leaves waiting, and the pieces of what waits and may match."""
    more = [c for c in texts.columns if c == "rest"]  # read by no one, but all joins then share one exchange
    found = _find_anchors(texts.join(firsts, _same_text()).select("doc", "text", "variant", *more), length)
    met = _meet(found.repartition("gram").sortWithinPartitions("gram", "context", "doc", "first", "variant"), HOT)

    hot = (F.col("kind") == WAITS_HOT).alias("hot")
    waits = met.where(f"kind <> {REMOVED}").groupBy(F.col("doc").alias("of_doc"), F.col("variant").alias("of_variant")).agg(F.collect_list(F.struct("gram", "first", "n", "offset", hot)).alias("waits"))
    cores = _cores(texts.join(waits, _of_variant()).select("doc", "text", F.col("of_variant").alias("variant"), "waits", *more), length)

    wanted = _shared(cores).groupBy(F.col("doc").alias("of_doc"), F.col("variant").alias("of_variant")).agg(F.collect_list(F.struct("core", "first", "n", "settled")).alias("wanted"))
    return met, _pieces(texts.join(wanted, _of_variant()).select("doc", "text", F.col("of_variant").alias("variant"), "wanted", *more), length)


def _found(texts: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """Runs of covered starts: of_doc, of_variant, runs."""
    if length < GRAM + SPREAD or length > 1000:
        raise ValueError(f"length must lie between {GRAM + SPREAD} and 1000")
    met, pieces = _dealt(texts, firsts, length)
    compared = _compare(pieces.repartition("core").sortWithinPartitions("core"), length)

    runs = met.where(f"kind = {REMOVED}").select("doc", "variant", F.col("first").cast("bigint").alias("first"), F.col("n").cast("bigint").alias("n")).unionByName(compared)
    return runs.groupBy(F.col("doc").alias("of_doc"), F.col("variant").alias("of_variant")).agg(F.collect_list(F.struct("first", "n")).alias("runs"))


def _marked(texts: DataFrame, length: int) -> DataFrame:
    """`texts`, packed, with the runs to cut (`runs`) and whether it is a later copy of a whole text (`copy`)."""
    small_batches(texts.sparkSession)
    firsts = _firsts(texts)
    texts = packed(texts, "text")
    runs = _found(texts, firsts, length)
    marked = texts.join(runs, _of_variant(), "left").join(firsts, _same_text(), "left")
    none = F.expr("cast(array() as array<struct<first: bigint, n: bigint>>)")
    return marked.withColumn("runs", F.coalesce("runs", none)).withColumn("copy", F.col("first_doc").isNull())


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the bytes left) of every row."""
    texts = _keyed(docs.select("doc_id", "text")).select("doc", "text", "text_hash")
    marked = _marked(texts, length).select("doc", "text", "runs", "copy")
    return _measure(marked, length).select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def strip_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows and columns of `docs` with the repeats cut out of `text`, and `n_chars` of what is left.

    Bytes of a character that a cut leaves incomplete go with it.
    """
    texts = _keyed(docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("rest"), "doc_id", "text")).select("doc", "text", "text_hash", "rest")
    marked = _marked(texts, length).select("rest", "text", "runs", "copy")
    schema = texts.select("rest", "text").schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches, "text"):
            raw, bounds = utf8(batch.column("text"))
            covered = cover(raw, bounds, batch.column("runs"), batch.column("copy"), length)
            kept = raw[~covered].tobytes()
            ends = np.append(0, np.cumsum(~covered))[bounds].tolist()
            left = [kept[a:b].decode(errors="ignore") for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(left, pa.string())], ["rest", "text"])

    stripped = marked.mapInArrow(work, schema)
    out = [F.col("text") if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("rest")[c].alias(c) for c in docs.columns]
    return stripped.select(*out)
