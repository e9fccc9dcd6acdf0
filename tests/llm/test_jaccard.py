"""The Jaccard join against all pairs by brute force."""

import random
import re

import numpy as np
import pytest

from strataloom.llm import jaccard, words
from strataloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def shingles(text, size):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if 0 < len(found) < size:
        return {tuple(found)}
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def brute(rows, size, numerator, denominator):
    """{row number: (set size, component)} by comparing every pair that shares a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_id, by_shingle = {}, {}
    for i, (d, _) in enumerate(rows):
        if d is None:
            continue
        root[find(i)] = find(by_id.setdefault(d, i))
        for s in sets[i]:
            by_shingle.setdefault(s, []).append(i)
    pairs = {(a, b) for group in by_shingle.values() for n, a in enumerate(group) for b in group[n + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if denominator * both >= numerator * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d if d is not None else -1), len(sets[i]), least[find(i)] if d is not None else -1) for i, (d, _) in enumerate(rows))


def answer(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


def test_shingle_sets():
    texts = ["", "  ", "one", "One two", "one two three", "a b a b a b", "x\x0by\tz w", "É b c D", "w" * 5000 + " q r s"]
    raw = [t.encode() for t in texts]
    bounds = np.append(0, np.cumsum([len(r) for r in raw]))
    hashes, counts = words.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), bounds, 3)
    assert counts.tolist() == [len(shingles(t, 3)) for t in texts]
    assert len(set(hashes.tolist())) == len(hashes)


def test_slices_change_nothing(monkeypatch):
    rnd = random.Random(3)
    text = " ".join(rnd.choice("alpha Beta gamma delta".split()) + str(rnd.randint(0, 99)) for _ in range(3000)).encode()
    raw, bounds = np.frombuffer(text + b"\n" + text, np.uint8), np.array([0, len(text), 2 * len(text) + 1])
    whole = words.word_hashes(raw, bounds)
    monkeypatch.setattr(words, "SLICE", 37)
    part = words.word_hashes(raw, bounds)
    assert (whole[0] == part[0]).all() and (whole[1] == part[1]).all() and whole[1].tolist() == [3000, 3000]


@pytest.mark.parametrize("size,numerator,denominator", [(3, 90, 100), (5, 4, 5)])
def test_planted_variants(spark, size, numerator, denominator):
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        text = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 9, 14, 25, 60, 150]))]
        for _ in range(rnd.choice([1, 3, 12])):
            changed = list(text)
            for _ in range(rnd.randint(0, max(1, len(text) // 30))):
                changed[rnd.randrange(len(changed))] = rnd.choice(vocabulary)
            rows.append((rnd.randint(0, 10**12), " ".join(changed)))
    rows += [(rnd.randint(0, 10**6), t) for t in ["", None, " ", "one", "one", "two words"]]
    rows += [rows[0], (None, rows[1][1]), (rows[2][0], "another text for the same id here"), (5, "another text for the same id here")]
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id bigint, text string, tile string")
    assert answer(jaccard.jaccard_components(docs, size, numerator, denominator)) == brute(rows, size, numerator, denominator)


def test_tiles_with_several_components(spark, monkeypatch):
    """Chains in one tile, where the leaders are linked with few: whole tiles must give the rest, in blocks too."""
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "EXACT_BLOCK", 5)
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(60):
        changed = list(base)
        for j in rnd.sample(range(400), 2 + i % 6):
            changed[j] = f"x{rnd.randint(0, 8)}"
        rows.append((i, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows, 3, 90, 100)
    assert 1 < len({r[2] for r in want}) < 60
    assert answer(jaccard.jaccard_components(docs, 3, 90, 100)) == want


def just_below(n, length, run, seed=5):
    """Texts of `length` words in which a run of each is replaced: far from the base, and from each other a little below 0.9."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    rows = []
    for i in range(n):
        at = rnd.randrange(length - run)
        rows.append((i, " ".join(base[:at] + [f"x{i}_{j}" for j in range(run)] + base[at + run :])))
    return rows


@pytest.mark.parametrize("block", [2048, 50])
def test_pairs_below_the_limit_are_compared_but_not_listed(spark, monkeypatch, block):
    """No step passes on more rows than it has sets, whatever the number of its open pairs."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "EXACT_BLOCK", block)
    calls = []

    def counted(label):
        whole = getattr(jaccard, label)

        def emit(tiles, bands):
            found = jaccard._written(whole(tiles, bands), "counted")
            calls.append((label, jaccard._blocks(tiles, block).count(), found.where("a < b").count(), found.where("a = b").count()))
            return found

        return emit

    for label in ("_open", "_exact_links"):
        monkeypatch.setattr(jaccard, label, counted(label))
    rows = just_below(240, 200, 11)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert answer(jaccard.jaccard_components(docs, 3, 90, 100)) == brute(rows, 3, 90, 100)
    assert [c[0] for c in calls] == ["_open", "_exact_links"]
    for label, given, pairs, sets in calls:
        assert pairs <= given and sets <= given, (label, given, pairs, sets)
    given = {c[0]: c[1] for c in calls}
    assert calls[0][2] > 0 and given["_exact_links"] > 0  # the case occurs
    blocks = -(-240 // block)
    assert given["_exact_links"] <= 240 * (2 * blocks + 1)  # each set comes once to every block, not to every tile


def test_overlaps_by_pairs_and_by_tables():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
    arrays = [np.sort(rng.choice(pool, rng.integers(1, 300), replace=False)) for _ in range(40)]
    left, right = np.triu_indices(40, 1)
    want = [len(set(arrays[a].tolist()) & set(arrays[b].tolist())) for a, b in zip(left, right, strict=True)]
    assert jaccard.overlaps(arrays, left, right).tolist() == want
    assert jaccard.overlaps(arrays, left[:5], right[:5]).tolist() == want[:5]


def test_no_rows_and_stage(spark):
    docs = spark.createDataFrame([(2, "a b c d e f g h", "x"), (1, "a b c d e f g h", "y"), (3, None, "z"), (None, "a b c d e f g h", "q")], "doc_id bigint, text string, component_id string")
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.component_id for r in kept.collect()) == ["q", "y", "z"]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert answer(QUERIES["op1_jaccard_join"](spark, FOLDER)) == brute(docs, 3, 90, 100)
