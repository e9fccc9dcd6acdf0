"""Removal of repeated byte strings against a brute-force scan."""

import hashlib
import random

import numpy as np
import pytest

from strataloom.llm import batches, repeats
from strataloom.llm.queries import QUERIES


def brute(rows, length=100):
    """[(doc_id, n_bytes, n_removed, n_spans, kept)] by a dictionary of all windows."""
    order = lambda d: repeats.NO_ID if d is None else d
    earliest = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, raw in data:
        for i in range(len(raw) - length + 1):
            w, at = raw[i : i + length], (order(d), i)
            if w not in earliest or at < earliest[w]:
                earliest[w] = at
    out = []
    for d, raw in data:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if earliest[raw[i : i + length]] < (order(d), i):
                gone[i : i + length] = True
        spans = int((gone[:-1] & ~gone[1:]).sum())
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((d, len(raw), len(raw) - len(kept), spans, kept))
    return sorted(out, key=lambda r: (order(r[0]), r[1:]))


def answer(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=lambda r: (repeats.NO_ID if r[0] is None else r[0], r[1:]))


def prose(rnd, n):
    return " ".join("".join(rnd.choice(["th", "an", "er", "é", "ion", "s"]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_previous_factors():
    rnd = np.random.default_rng(0)
    text = rnd.integers(0, 2, 400).astype(np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(text, 9)
    position = rnd.permutation(len(windows))
    group = np.repeat([0, 1], [200, len(windows) - 200])
    got = repeats.has_earlier(windows, group, position)
    least = {}
    for w, g, p in zip(map(bytes, windows), group, position, strict=True):
        least[w, g] = min(p, least.get((w, g), p))
    assert got.tolist() == [least[bytes(w), g] < p for w, g, p in zip(windows, group, position, strict=True)]


def test_pieces_of_long_texts(monkeypatch):
    raw = np.frombuffer(prose(random.Random(5), 900).encode(), np.uint8)
    bounds = np.array([0, 50, 50, 1500, len(raw)])
    whole = repeats.anchors(raw, bounds, 100, 24)
    monkeypatch.setattr(repeats, "PIECE", 333)
    part = repeats.anchors(raw, bounds, 100, 24)
    cover = [sorted((t, f + k, f + o) for t, f, n, o in zip(*x[:4], strict=True) for k in range(n)) for x in (whole, part)]
    assert cover[0] == cover[1]
    assert len(cover[0]) == sum(max(0, b - a - 99) for a, b in zip(bounds, bounds[1:], strict=False))


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_repeats(spark, seed):
    rnd = random.Random(seed)
    passages = [prose(rnd, n) for n in (20, 25, 40, 100)]
    rows = []
    for _ in range(60):
        parts = [prose(rnd, rnd.randint(0, 40)) for _ in range(rnd.randint(1, 4))]
        for p in rnd.sample(passages, rnd.randint(0, 2)):
            cut = rnd.randint(0, len(p) // 2)
            parts.insert(rnd.randrange(len(parts) + 1), p[cut:] if rnd.random() < 0.5 else p)
        rows.append((rnd.randint(0, 10**9), " ".join(parts)))
    rows += [(5, rows[3][1]), (6, rows[3][1]), (10**10, rows[3][1]), rows[7], (None, rows[8][1]), (None, None), (7, ""), (8, "a" * 99), (9, "a" * 350), (11, "a" * 100), (rows[9][0], "b" * 30 + rows[10][1]), (12, ("xyz " + prose(rnd, 12)) * 9)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, doc int").repartition(5)
    assert answer(repeats.remove_repeats(docs)) == brute(rows)


def test_stage_keeps_rows_and_columns(spark):
    rnd = random.Random(9)
    passage = prose(rnd, 60)
    rows = [(i, prose(rnd, 20) + " é" + passage + "é " + prose(rnd, 20), "runs", i, None) for i in range(6)] + [(None, None, "x", 1, None), (2, "short", "y", 1, None), (2, "short", "y", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, n_chars bigint, copy string")
    got = repeats.strip_repeats(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    want = sorted(((d, kept.decode(errors="ignore")) for d, _, _, _, kept in brute([r[:2] for r in rows])), key=str)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == want
    assert all(r.n_chars == len(r.text) and r.runs for r in got.collect())


def test_no_rows(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op3_repeats"](spark, folder).collect())
    assert got == want and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("hot", [0, 5])
def test_hot_passages_are_dealt_out(spark, monkeypatch, hot):
    """A passage with other neighbours in every document: right cuts, and no group of pieces with them all."""
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "ITEMS", 50)
    rnd = random.Random(3)
    passage = prose(rnd, 30)
    rows = [(i, prose(rnd, 25) + rnd.choice(["x", " y"]) + passage + rnd.choice([".", ", "]) + prose(rnd, 25)) for i in rnd.sample(range(1000), 150)]
    rows += [rows[0], (rows[1][0], rows[2][1] + "z"), (None, rows[3][1] + "q"), (2000, passage), (2001, ("ab" * 60 + prose(rnd, 3)) * 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert answer(repeats.remove_repeats(docs)) == brute(rows)
    texts = repeats._keyed(docs).select("doc", "text", "text_hash").cache()
    pieces = repeats._dealt(texts, repeats._firsts(texts), 100)[1].where("bytes IS NOT NULL")
    assert max(r["count"] for r in pieces.groupBy("core").count().collect()) < 40


def test_bytes_are_sent_only_where_windows_may_match(spark):
    """Texts that share an anchor but no window of 100 bytes meet by name alone, repeated rows and ids too."""
    rnd = random.Random(4)
    word = prose(rnd, 60).encode()[:60].decode(errors="ignore")
    rows = [(i, prose(rnd, 60) + word + prose(rnd, 60)) for i in range(40)]
    rows += [rows[0], rows[0], (rows[1][0], prose(rnd, 60) + word + prose(rnd, 60))]
    both = [(100 + i, prose(rnd, 30) + rows[2][1][:300] + word + str(i)) for i in range(2)]

    def sent(rows):
        texts = repeats._keyed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).select("doc", "text", "text_hash").cache()
        met, pieces = repeats._dealt(texts, repeats._firsts(texts), 100)
        assert met.where(f"kind <> {repeats.REMOVED}").count() > 40
        return {r.doc for r in pieces.select("doc").distinct().collect()}

    assert sent(rows) == set()
    assert sent(rows + both) == {2, 100, 101}
    docs = spark.createDataFrame(rows + both, "doc_id bigint, text string").repartition(3)
    assert answer(repeats.remove_repeats(docs)) == brute(rows + both)


def test_texts_move_packed(spark, monkeypatch):
    rnd = random.Random(6)
    texts = ["", "a" * 300_000, "é" * 7, *(prose(rnd, 400) for _ in range(30))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    moved = repeats._marked(repeats._keyed(docs).select("doc", "text", "text_hash"), 100).select("doc", "text")
    assert dict(moved.dtypes)["text"] == "binary"
    monkeypatch.setattr(batches, "UNPACKED", 10_000)
    parts = list(batches.unpacked(moved.toArrow().combine_chunks().to_batches(), "text"))
    assert {i: t.decode() for p in parts for i, t in zip(p.column("doc").to_pylist(), p.column("text").to_pylist(), strict=True)} == dict(enumerate(texts))
    assert all(p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= 10_000 for p in parts) and len(parts) > 3
    assert sum(map(len, moved.toPandas()["text"])) < sum(len(t.encode()) for t in texts) / 2
