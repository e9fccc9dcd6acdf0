"""Language models: probabilities, accuracy on held-out rows, rejection and odd rows."""

import random

import numpy as np
import pytest

from strataloom.llm import langid
from strataloom.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, bits string"


def sentences(words, n, seed):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(5, 40))) + "." for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    a = sentences("the of and house water running through small gardens".split(), 150, 1)
    b = sentences("der die und haus wasser läuft durch kleine gärten".split(), 150, 2)
    rows = [(i, t, "xa" if i < 150 else "xb", "z") for i, t in enumerate(a + b)]
    return spark.createDataFrame(rows, DOCS)


def test_probabilities_sum_to_one():
    grams, rows = {}, []
    text = "abracadabra alakazam abrakadabra"
    seq, counts = langid.codes([text], 3)
    for i in range(len(text)):
        grams[tuple(seq[i : i + 3])] = grams.get(tuple(seq[i : i + 3]), 0) + 1
    rows = sorted(grams)
    models = langid.kneser_ney(["x"], np.array(rows, np.uint64), np.array([[grams[r]] for r in rows], float))
    alphabet = sorted(set(seq.tolist()))
    for context in [[ord("a"), ord("b")], [ord("z"), ord("z")], [32, 32]]:
        total = sum(2 ** float(models.log_probabilities(np.array([*context, c], np.uint64), np.array([2]))[0, 0]) for c in alphabet)
        assert 0.9 < total <= 1.0001
    # by hand: the continuation count of an n-gram is the number of its different left neighbours
    left = {r[0] for r in rows if r[1:] == (ord("b"), ord("r"))}
    assert left == {ord("a")}


def test_accuracy_rejection_and_odd_rows(spark, docs):
    models = langid.fit(docs)
    assert models.languages == ["xa", "xb"]
    odd = spark.createDataFrame(
        [(None, "wasser und haus", None, "q"), (1000, None, "xa", "q"), (1001, "", "xa", "q"), (1002, " 12 % \n", None, "q"), (1003, "qxzj vvkq zzxq wwqk jjqx " * 40, "xa", "q"), (1004, "und und " * 50000, None, "q"), (1004, "und und " * 50000, None, "q")],
        DOCS,
    )
    got = {r.doc_id: r for r in langid.predict(odd, models).collect()}
    assert got[None].lang_pred == "xb" and got[None].held_out is False
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score, got[i].rejected, got[i].bits) == ("und", 0.0, True, None)
    assert got[1003].rejected and got[1003].lang_pred in ("xa", "xb")
    assert got[1004].lang_pred == "xb" and not got[1004].rejected
    told = langid.predict(docs, models).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang == r.lang_pred and not r.rejected and 0 <= r.score <= 1 for r in told)
    kept = langid.keep_known(docs.unionByName(odd))
    assert kept.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted([*range(300), -1, 1004, 1004])


def test_split_batches_change_nothing(docs):
    models = langid.fit(docs)
    texts = [r.text for r in docs.collect()]
    whole, n = models.entropies(texts)
    for i in (0, 151):
        one, k = models.entropies([texts[i]])
        assert np.allclose(one[0], whole[i]) and k[0] == n[i]


def test_nothing_to_learn(spark, docs):
    empty = docs.limit(0)
    assert langid.identify(empty).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang", "bits")
    assert {(r.lang_pred, r.rejected) for r in langid.identify(unlabelled).collect()} == {("und", True)}
    assert langid.keep_known(unlabelled).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language"](spark, folder).join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == truth.count() and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
    assert not any(r.rejected for r in rows)


def test_a_few_bad_calibration_rows_loosen_nothing(spark, docs):
    """Garbage and rows of another language among the calibration rows of a language."""
    clean = langid.fit(docs)
    calibrates = langid.sampled(spark.range(5000, 9000).selectExpr("id doc_id", "'xa' lang", "'t' text"), 10**6).where("calibrates").limit(3).collect()
    rnd = random.Random(4)
    garbage = lambda n: "".join(rnd.choice("qxzjvkwyñøßłþ ") for _ in range(n))
    texts = [garbage(400), "der die und haus wasser durch kleine gärten " * 20, "läuft durch kleine gärten und " * 30]
    mixed = docs.unionByName(spark.createDataFrame([(r.doc_id, t, "xa", "z") for r, t in zip(calibrates, texts, strict=True)], DOCS))
    models = langid.fit(mixed)
    assert np.allclose(models.limits, clean.limits, atol=0.5)
    probes = [garbage(n) for n in (60, 100, 300, 1000)]
    assert langid.classify(models, probes)[2].to_pylist() == [True] * 4
    told = langid.predict(docs, models).collect()
    assert not any(r.rejected for r in told)
