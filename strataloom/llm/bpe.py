"""Byte-level BPE: encode whole texts by forced-boundary splitting, and decode.

A byte pair that occurs inside no token of the vocabulary can never be merged,
so a text may be cut between such bytes. Whole texts are cut where the second
byte is ASCII white space: the pre-tokenizer has no match that runs over such a
place except a run of white space, and that run is cut by the pair itself. The
fragments ("white space + word") are encoded independently, each different one
of a batch once, and the ids are concatenated. Inside a fragment the
pre-tokenizer's pieces are cut again at forced boundaries, and the pieces of
all fragments are merged together, round by round. Only vocabularies with the byte-level pre-tokenizer are accepted.

Cases: a null text counts as empty and has no ids. Every row gives one row,
repeated rows and null ids included; other columns are not looked at. Texts are
never cut short. The strings of added tokens are recognised in the text, as
the tokenizers library does by default.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from strataloom.llm.batches import binary_column, gather, small_batches, utf8

VOCABULARY = "byte_bpe_50k.json"
LONG = 64  # bytes from which a piece is merged with a heap
NEVER = 1 << 60
SPREAD = 0x9E3779B97F4A7C15
EMPTY = np.uint64((1 << 64) - 1)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: White space, letters, digits and the rest, for bytes of ASCII and Latin-1 letters.
CLASS = np.full(256, 3, np.uint8)
CLASS[WHITE] = 0
CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = 1
CLASS[48:58] = 2


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Rank of many pairs of ids at a time: open addressing in flat arrays."""

    def __init__(self, pairs: list[tuple[int, int]]):
        self.shift = np.uint64(64 - max(4, (4 * len(pairs)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), EMPTY, np.uint64)
        self.ranks = np.full(len(self.keys), NEVER, np.int64)
        for rank, (a, b) in enumerate(pairs):
            key = a << 32 | b
            slot = (key * SPREAD & (1 << 64) - 1) >> int(self.shift)
            while self.keys[slot] != EMPTY:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.ranks[slot] = key, rank

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = ((key * np.uint64(SPREAD)) >> self.shift).astype(np.int64)
        there = self.keys[slot]
        out = np.where(there == key, self.ranks[slot], NEVER)
        open_ = np.flatnonzero((there != key) & (there != EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self.keys)
            there = self.keys[slot[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (there != EMPTY)]
        return out


class ByteBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and spec.get("normalizer") is None
        if not plain or model.get("dropout") or model.get("ignore_merges") or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in added}
        if any(WHITE[b] for t in self.special for b in t.encode()):
            raise ValueError("added tokens with white space are not supported")
        tokens = [b""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        for token, i in model["vocab"].items():
            tokens[i] = token.encode() if token in self.special else bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.tokens = pa.array(tokens, pa.binary())
        self.inside = np.zeros(65536, bool)
        for token in tokens:
            for a, b in zip(token, token[1:], strict=False):
                self.inside[a << 8 | b] = True
        vocab = model["vocab"]
        self.byte_id = np.array([vocab[c] for c in sorted(alphabet, key=alphabet.get)], np.int64)
        pairs = [tuple(vocab[x] for x in (m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        self.rank = {pair: rank for rank, pair in enumerate(pairs)}
        self.merged = np.array([vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]], np.int64)
        self.table = MergeTable(pairs)
        self.pieces = regex.compile(public_tokenizers.PATTERN)
        self.added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.odd_byte = np.zeros(256, bool)  # bytes that send a fragment to the pattern itself
        self.odd_byte[[39, *{t.encode()[0] for t in self.special}, *range(0x80, 0xC3), *range(0xC4, 0x100)]] = True

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length: linked cells and a heap, lowest rank first, left before right."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in self.rank]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n and (ids[a], ids[b]) in self.rank:
                    heapq.heappush(heap, (self.rank[ids[a], ids[b]], a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def merge_short(self, ids: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces at once and the piece of each; `piece` numbers the pieces and does not fall.

        In each round every piece merges all places of its lowest rank: a pair
        that holds a new id always ranks behind the pair that made it.
        """
        done_ids, done_piece = [], []
        rank = np.full(len(ids), NEVER, np.int64)
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inner] = self.table(ids[inner], ids[inner + 1])
        while len(ids):
            begins = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            low = np.minimum.reduceat(rank, begins)
            width = np.diff(np.append(begins, len(ids)))
            low = np.repeat(low, width)
            ready = low == NEVER
            if ready.any():
                done_ids.append(ids[ready])
                done_piece.append(piece[ready])
                ids, piece, rank, low = ids[~ready], piece[~ready], rank[~ready], low[~ready]
            at = np.flatnonzero(rank == low)
            if not len(at):
                continue
            touching = np.flatnonzero(np.diff(at) == 1)
            if len(touching):  # a run of one id: every second place of the run merges
                run = np.append(0, np.cumsum(np.diff(at) != 1))
                first = np.flatnonzero(np.append(True, np.diff(run) != 0))
                at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            ids[at] = self.merged[rank[at]]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            ids, piece, rank = ids[stay], piece[stay], rank[stay]
            at = moved[at]
            redo = np.concatenate([at, at[at > 0] - 1])
            ends = (redo + 1 >= len(ids)) | (piece[np.minimum(redo + 1, len(ids) - 1)] != piece[redo])
            rank[redo[ends]] = NEVER
            redo = redo[~ends]
            rank[redo] = self.table(ids[redo], ids[redo + 1])
        if not done_ids:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ids, piece = np.concatenate(done_ids), np.concatenate(done_piece)
        by = np.argsort(piece, kind="stable")
        return ids[by], piece[by]

    def fragments(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many fragments, one after the other, and their number for each.

        Fragments of ASCII and Latin-1 letters are split by runs of byte
        classes; the others by the pre-tokenizer's pattern.
        """
        n = len(bounds) - 1
        owner = np.repeat(np.arange(n), np.diff(bounds))
        follows = np.append(0, raw[:-1]) == 0xC3
        odd = self.odd_byte[raw] & ~(follows & (raw >= 0x80) & (raw < 0xC0) & (raw != 0x97) & (raw != 0xB7))
        odd |= WHITE[raw] & (np.arange(len(raw)) != bounds[owner])  # white space only where a fragment begins
        odd_fragment = np.zeros(n, bool)
        odd_fragment[owner[odd]] = True
        kind = CLASS[raw]
        begin = np.append(True, kind[1:] != kind[:-1])
        begin[bounds[:-1]] = True
        after_space = np.append(False, raw[:-1] == 32)
        begin &= ~after_space | np.append(True, owner[1:] != owner[:-1])  # a blank belongs to what follows it
        pair = np.append(0, raw[:-1]).astype(np.uint16) << 8 | raw
        begin |= ~self.inside[pair]
        special: dict[tuple[int, int], list[int]] = {}
        for i in np.flatnonzero(odd_fragment):
            a, b = int(bounds[i]), int(bounds[i + 1])
            begin[a + 1 : b] = False
            at = a
            text = raw[a:b].tobytes().decode()
            for part in self.added.split(text) if self.added else [text]:
                if part in self.special:
                    special[at, at + len(part.encode())] = [self.special[part]]
                    begin[at] = True
                    at += len(part.encode())
                    continue
                for match in self.pieces.findall(part):
                    begin[at] = True
                    at += len(match.encode())
            if at < b:
                begin[at] = True
            cut = np.flatnonzero(~self.inside[pair[a + 1 : b]]) + a + 1
            begin[cut] = True
        for a, b in special:
            begin[a + 1 : b] = False
            if b < len(raw):
                begin[b] = True
        starts = np.flatnonzero(begin)
        length = np.diff(np.append(starts, len(raw)))
        for i in np.flatnonzero(length > LONG):
            a, b = int(starts[i]), int(starts[i] + length[i])
            if (a, b) not in special:
                special[a, b] = self.merge_long(raw[a:b].tobytes())
        piece = np.repeat(np.arange(len(starts)), length)
        apart = np.zeros(len(starts), bool)
        lone = np.array(sorted(special), np.int64).reshape(-1, 2)
        apart[np.searchsorted(starts, lone[:, 0])] = True
        short = ~apart[piece]
        ids, of = self.merge_short(self.byte_id[raw[short]], piece[short])
        if len(lone):
            numbers = np.searchsorted(starts, lone[:, 0])
            more = [special[tuple(x)] for x in lone.tolist()]
            ids = np.concatenate([ids, *[np.array(x, np.int64) for x in more]])
            of = np.concatenate([of, np.repeat(numbers, [len(x) for x in more])])
            by = np.argsort(of, kind="stable")
            ids, of = ids[by], of[by]
        return ids.astype("<u4"), np.bincount(owner[starts[of]], minlength=n)

    def cuts(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sorted starts of all fragments: beginnings of texts and certain cuts before white space."""
        start = WHITE[raw]
        spaces = np.flatnonzero(start[1:]) + 1
        pairs = raw[spaces - 1].astype(np.uint16) << 8 | raw[spaces]
        start[spaces[self.inside[pairs]]] = False
        start[bounds[:-1][np.diff(bounds) > 0]] = True
        return np.flatnonzero(start)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after the other, and their number for each text."""
        raw, bounds = utf8(column)
        starts = self.cuts(raw, bounds)
        if not len(starts):
            return np.empty(0, "<u4"), np.zeros(len(bounds) - 1, np.int64)
        ends = np.append(starts, len(raw)).astype(np.int32 if len(raw) < 2**31 - 1 else np.int64)
        kind, maker = (pa.binary(), pa.BinaryArray) if ends.dtype == np.int32 else (pa.large_binary(), pa.LargeBinaryArray)
        coded = maker.from_buffers(kind, len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw)]).dictionary_encode()
        pool, sizes = self.fragments(*utf8(coded.dictionary))
        which = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[which]
        ids = pool[gather((np.cumsum(sizes) - sizes)[which], lengths)]
        before = np.append(0, np.cumsum(lengths))
        return ids, np.diff(before[np.searchsorted(starts, bounds)])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of id runs; bytes that are no UTF-8 become U+FFFD."""
        pieces = pc.take(self.tokens, pa.array(ids))
        _, offsets, data = pieces.buffers()
        at = np.frombuffer(offsets, np.int32)[: len(ids) + 1]
        raw = data.to_pybytes() if data is not None else b""
        bounds = at[np.append(0, np.cumsum(counts))]
        return pa.array([raw[a:b].decode(errors="replace") for a, b in zip(bounds, bounds[1:], strict=False)], pa.string())


_loaded: dict[str, ByteBPE] = {}


def vocabulary(path: str | None = None) -> ByteBPE:
    """The encoder of a vocabulary file, loaded once in each worker."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every row."""
    return _run(docs.select("doc_id", "text"), path, "doc_id bigint, n_tokens bigint, ids binary", decoded=False)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """As `encode`, with the text that the ids decode to, in one pass."""
    return _run(docs.select("doc_id", "text"), path, "doc_id bigint, n_tokens bigint, ids binary, decoded string", decoded=True)


def _run(docs: DataFrame, path: str | None, schema: str, decoded: bool) -> DataFrame:
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            ids, counts = bpe.encode(batch.column("text"))
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts), "ids": binary_column(ids, counts)}
            if decoded:
                columns["decoded"] = bpe.decode(ids, counts)
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows with `ids` as `encode` writes them; null ids are an empty text."""
    small_batches(encoded.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            rows = [x or b"" for x in batch.column("ids").to_pylist()]
            counts = np.array([len(x) // 4 for x in rows], np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": bpe.decode(np.frombuffer(b"".join(rows), "<u4"), counts)})

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id bigint, text string")
