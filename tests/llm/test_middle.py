"""Fill-in-the-middle forms against the token pattern applied to whole texts."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strataloom.llm import middle
from strataloom.llm.batches import utf8
from strataloom.llm.queries import ORACLE, QUERIES

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text, rate=50, spm=80):
    """n, form, prefix_chars, middle_chars, output, one token at a time."""
    text, tokens = text or "", TOKEN.findall(text or "")
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t\x0b\x0c\r\xa0ab é語"), st.characters(codec="utf-8")), max_size=60), min_size=1, max_size=6), st.sampled_from([1, 3, 2048]))
def test_counts_and_cuts(texts, longest):
    old, middle.LONGEST = middle.LONGEST, longest
    try:
        counted = middle.Counted(*utf8(pa.array(texts, pa.string())), middle.Memo(64))
    finally:
        middle.LONGEST = old
    tokens = [TOKEN.findall(t) for t in texts]
    assert counted.n.tolist() == [len(t) for t in tokens]
    for k in range(max(map(len, tokens)) + 1):
        at, chars = counted.cut(np.minimum(k, counted.n))
        heads = ["".join(t[:k]) for t in tokens]
        assert at.tolist() == [len(h.encode()) for h in heads] and chars.tolist() == [len(h) for h in heads]


def test_chunks_depend_on_content_alone():
    rnd = random.Random(5)
    text = " ".join(rnd.choice(["alpha", "béta", "gamma", "δ", "eps\n"]) + str(rnd.randrange(99)) for _ in range(300_000))
    raw, bounds = utf8(pa.array(["x" * 7, text, "", text, "yy" + text, "a" * 10_000], pa.string()))
    assert len(text.encode()) > 2 * middle.SLICE
    edges = middle.chunk_bounds(raw, bounds)
    assert edges[0] == 0 and edges[-1] == len(raw) and (np.diff(edges) > 0).all() and np.diff(edges).max() <= middle.LONGEST and np.isin(bounds, edges).all()
    inside = [edges[(edges >= bounds[i]) & (edges <= bounds[i + 1])] - bounds[i] for i in (1, 3, 4)]
    assert inside[0].tolist() == inside[1].tolist()
    assert len(np.intersect1d(inside[0], inside[2] - 2)) > 0.99 * len(inside[0])
    memo = middle.Memo()
    middle.Counted(raw, bounds, memo)
    assert memo.summed < 0.4 * memo.asked  # the text is there three times


def test_frames(spark):
    rnd = random.Random(9)
    rows = [(i, "".join(rnd.choice("ab é\n ") for _ in range(rnd.randrange(40)))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "no id at all"), (902, " "), (903, "a <M> b"), (904, "< P> <S"), (7, "repeated row"), (7, "repeated row"), (905, "wörd " * 40_000), (906, "a" * 300_000)]
    docs = spark.createDataFrame([(d, t, "n", "f") for d, t in rows], "doc_id bigint, text string, n string, form string")
    formed = middle.fill_in_middle(docs)
    got = formed.withColumn("back", middle.restored(formed["output"], formed["form"])).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got), key=key) == sorted(((d, *plainly(d, t), t or "") for d, t in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(docs.limit(0)).count() == 0
    whole = middle.fill_in_middle(docs, rate=100, spm=0, sentinels=("[pre]", "[suf]", "[mid]"))
    assert {r.form for r in whole.where("length(output) > 0").collect()} == {"psm"}


def test_no_shuffle(spark, plan_of):
    assert "Exchange" not in plan_of(QUERIES["op11_fill_in_middle"](spark, "/root/testdata/sf0.001"))
    assert "op11_fill_in_middle" in ORACLE
