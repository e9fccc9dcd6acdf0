"""Token matrices: best fit against a plain search, and a lossless way back to every document."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strataloom.llm import matrices
from strataloom.llm.queries import QUERIES
from strataloom.session import new_dir

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_best_fit_decreasing():
    rnd = random.Random(2)
    for width in (1, 7, 64, 100):
        lengths = np.array([rnd.randint(1, width) for _ in range(300)])
        where, rows = matrices.best_fit_decreasing(lengths, width)
        assert np.bincount(where, lengths, rows).max() <= width
        room = []
        for i in np.argsort(-lengths, kind="stable"):  # the same sizes of room are left as in a plain search
            fit = [r for r in range(len(room)) if room[r] >= lengths[i]]
            best = min(fit, key=lambda r: room[r], default=None)
            if best is None:
                room.append(width - lengths[i])
            else:
                room[best] -= lengths[i]
        assert sorted(room) == sorted((width - np.bincount(where, lengths, rows)).tolist())


def restored(rows, kind="<u2"):
    """{(doc_id): sorted list of id lists} put together from the segments of all rows."""
    parts = {}
    for r in rows:
        ids = np.frombuffer(r.ids, kind)
        assert r.resets == r.cu_seqlens[:-1] and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens :] == matrices.CLOSING).all()
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            parts.setdefault((r.shard, r.window, d), []).append((s, ids[a:b].tolist()))
    out = {}
    for (_, _, d), found in parts.items():
        out.setdefault(d, []).append([x for _, ids in sorted(found) for x in ids])
    return out


def test_round_trip(spark):
    docs = [(1, "a b c"), (2, None), (3, ""), (4, "long text " * 400), (None, "no id"), (5, "é ü 日本")] + [(10 + i, "word " * (i % 37)) for i in range(150)]
    frame = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id bigint, text string, shard string").repartition(4)
    written = matrices.write_matrices(frame, new_dir(spark, "test"), width=64, window=500)
    rows = written.collect()
    assert {len(r.ids) for r in rows} == {128}
    assert restored(rows) == {d: [[*LIBRARY.encode(t or "", add_special_tokens=False).ids, matrices.CLOSING]] for d, t in docs}
    assert matrices.segments(written).where("length <= 0").count() == 0
    assert matrices.segments(written).count() == sum(len(r.doc_ids) for r in rows)
    assert matrices.matrix_rows(frame.limit(0)).count() == 0


def test_query(spark):
    rows = QUERIES["op2_token_matrices"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    total = sum(len(LIBRARY.encode(d.text, add_special_tokens=False).ids) + 1 for d in docs)
    assert sum(r.n_tokens for r in rows) == total
    assert len(rows) <= total / 2048 * 1.02 + len({(r.shard, r.window) for r in rows})
