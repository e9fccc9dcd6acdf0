"""Fingerprints against a parse of one symbol at a time, and their locality."""

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strataloom.llm import fingerprints as fp
from strataloom.llm.batches import utf8
from strataloom.llm.queries import QUERIES
from strataloom.llm.words import BYTE, mix

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ALL = (1 << 64) - 1


def mixed(x):
    return int(mix(np.array([x & ALL], np.uint64))[0])


def toss(symbol, before):
    differ = symbol ^ before
    bit = (differ & -differ).bit_length() - 1
    return 2 * bit + (symbol >> bit & 1)


def parsed(text):
    """Names of every level, by plain loops."""
    names, found = [int(BYTE[b]) for b in text.encode()], []
    while names and (not found or len(names) > 1):
        runs = []
        for x in names:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        names = [x if n == 1 else mixed(x * int(fp._RUN) + n) for x, n in runs]
        labels = names
        for _ in range(4):
            labels = [toss(x, labels[i - 1] if i else x ^ 1) for i, x in enumerate(labels)]
        assert max(labels) < 6
        for high in (3, 4, 5):
            labels = [min({0, 1, 2} - {*labels[max(i - 1, 0) : i], *labels[i + 1 : i + 2]}) if x == high else x for i, x in enumerate(labels)]
        begins = [i for i, x in enumerate(labels) if i == 0 or (i + 1 < len(labels) and labels[i - 1] < x > labels[i + 1])]
        phrases = [names[a:b] for a, b in zip(begins, [*begins[1:], len(names)], strict=True)]
        assert all(len(p) > 1 for p in phrases[1:]) or len(phrases) == 1
        names = [mixed(sum(x * int(c) for x, c in zip(p, fp._COEFFICIENTS)) + len(p) * int(fp._RUN)) for p in phrases]
        found.append(names)
    return found


def by_levels(texts):
    raw, bounds = utf8(pa.array(texts, pa.string()))
    out = [[] for _ in texts]
    for names, owner in fp.levels(raw, bounds):
        for i in np.unique(owner):
            out[i].append(names[owner == i].tolist())
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab \né"), max_size=80), min_size=1, max_size=5))
def test_levels(texts):
    assert by_levels(texts) == [parsed(t) for t in texts]


def test_equal_substrings_share_interior_phrases():
    rnd = random.Random(2)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    common = word(4000)
    a, b = by_levels([word(137) + common + word(50), word(61) + common])
    alone = by_levels([common])[0]
    for depth in range(5):
        for other in (a, b):
            shared = set(alone[depth]) & set(other[depth])
            assert len(set(alone[depth]) - shared) <= 14, depth


def test_likeness():
    rnd = random.Random(4)
    text = " ".join(rnd.choice(["ka", "lo", "minu", "tere", "sada", "vesi", "x"]) + str(rnd.randrange(50)) for _ in range(2000))
    other = " ".join(rnd.choice(["ka", "lo", "minu", "tere", "sada", "vesi", "x"]) + str(rnd.randrange(50)) for _ in range(2000))
    same, again, changed, far, empty, blank = fp.fingerprints_of([text, text, text[:-3000] + other[:3000], other, "", ""])
    assert str(same) == str(again) and same.likeness(again) == 1.0 and empty.likeness(blank) == 1.0 and same.likeness(empty) == 0.0
    share = 1 - 3000 / len(text)
    assert abs(same.likeness(changed) - share / (2 - share)) < 0.15 and same.likeness(far) < 0.1
    for f in (same, changed, empty):
        assert str(fp.Fingerprint.parse(str(f))) == str(f) and fp.Fingerprint.parse(str(f)).likeness(same) == f.likeness(same)
    one, two = fp.fingerprints_of(["na na na na", "na na na no"])
    x, y = ([(n, d[:i].count(n)) for i, n in enumerate(d)] for d in (parsed("na na na na")[0], parsed("na na na no")[0]))
    assert one.likeness(two) == len({*x} & {*y}) / len({*x} | {*y})


def expected(rows):
    """By doc_id: code points and digest of the edited text."""
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for (d, t), (_, after) in zip(rows, [*rows[1:], *rows[:1]], strict=True):
        t, after = t or "", after or ""
        n = len(t) // 4
        out[d] = (len(t), hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest())
    return out


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = QUERIES["op13_fingerprints"](spark, FOLDER).collect()
    assert len(found) == len(rows) and {r.doc_id: (r.n_chars, r.edited_sha256) for r in found} == expected(rows)
    own = dict(zip([d for d, _ in rows], fp.fingerprints_of([t or "" for _, t in rows]), strict=True))
    order = sorted(own)
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    for r in found:
        assert r.fingerprint == str(own[r.doc_id])
        assert r.near_edited == own[r.doc_id].likeness(fp.Fingerprint.parse(r.edited_fingerprint))
        assert r.near_next == own[r.doc_id].likeness(own[after[r.doc_id]])
    long = [r for r in found if r.n_chars >= 20]
    assert sum(r.near_edited for r in long) / len(long) > 0.5 and sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)


def test_odd_rows(spark):
    rnd = random.Random(8)
    rows = [(i * 3 - 50, "".join(rnd.choice("ab ü") for _ in range(rnd.randrange(60)))) for i in range(200)]
    rows += [(10_000, None), (10_001, ""), (10_002, "é" * 100_000), (10_003, "one more")]
    docs = spark.createDataFrame([(d, t, "e", "f") for d, t in rows], "doc_id bigint, text string, edited string, fingerprint string").repartition(7)
    found = fp.with_next(docs).collect()
    assert {r.doc_id: (r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in found} == expected(rows) and len(found) == len(rows)
    assert fp.with_next(docs.limit(0)).count() == 0
    alone = fp.with_next(docs.where("doc_id = 10003")).collect()
    assert [(r.edited, r.near_next) for r in alone] == [("one moon", 1.0)]
    assert fp.fingerprint(docs).count() == len(rows)


def test_very_many_equal_rows_are_dealt_to_several_ranges(spark):
    docs = spark.createDataFrame([(5, "the same text")] * 4000 + [(None, "without id"), (None, "without id"), (9, "later")], "doc_id bigint, text string")
    found = fp.with_next(docs).collect()
    assert len(found) == 4003 and sum(r.near_next == 1.0 for r in found if r.doc_id == 5) == 3999
    assert sorted(r.edited for r in found if r.doc_id is None) == ["without th", "without wi"]
    assert {r.edited for r in found if r.doc_id == 9} == {"latew"}
