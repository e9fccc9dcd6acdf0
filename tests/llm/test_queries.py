"""The register of this package: names, SQL where there is some, and odd rows of the native operator."""

import os
import random
import re

import pytest

import compare
from strataloom.llm import exact_copies
from strataloom.llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) == {"op5_neighbours", "op7_exact_copies", "op11_fill_in_middle"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLE[name]) is None


def test_native_plans(spark, plan_of):
    for name in ("op4_licences", "op7_exact_copies"):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_copies_of_odd_rows(spark):
    rnd = random.Random(3)
    long = " ".join(rnd.choice(["a", "Bee", "cé", "É", "dd"]) for _ in range(9000))
    rows = [(1, "Text"), (2, "tEXT"), (3, "text "), (4, None), (5, ""), (None, ""), (6, "É"), (7, "é"), (8, long), (9, long.replace("Bee", "bee")), (10, long + "."), (None, "only null"), (None, "only null"), (11, "twice"), (11, "twice"), (2, "other")]
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id bigint, text string, recipe string, rid string")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(lower(t), []).append(d)
    best = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    want = sorted((str(d), str(best[lower(t)]), len(groups[lower(t)]), d == best[lower(t)]) for d, t in rows)
    got = exact_copies.exact_copies(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == want
    kept = exact_copies.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), lower(r.text)) for r in kept.collect()) == sorted((str(d), t) for t, d in best.items())
    assert exact_copies.exact_copies(docs.limit(0)).count() == 0


def test_shared_names_are_told_apart(spark, monkeypatch):
    """Chunks of different texts that bear one name: the whole texts decide."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.keep_id) for r in exact_copies.exact_copies(docs).collect()) == [(1, 3), (2, 2), (3, 3)]
