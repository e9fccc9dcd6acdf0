"""Block matrix join against brute force."""

import math

import numpy as np

from strataloom.llm import neighbours
from strataloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def brute(rows, queries, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i] = min(usable.get(i, v), v, key=lambda x: (len(x), x))
    out = []
    for q in sorted(set(queries) & set(usable)):
        own = np.array(usable[q])
        scored = []
        for i, v in usable.items():
            if i != q and len(v) == len(own):
                w = np.array(v)
                scored.append((-float(own @ w / math.sqrt((own @ own) * (w @ w))), i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted((round(s, 12), i) for s, i in scored)[:k])]
    return out


def answer(df):
    return [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.orderBy("query_id", "rank").collect()]


def near(rows):
    return [(q, n, i, round(s, 9)) for q, n, i, s in rows]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for scale in (1e-30, 1, 1e30):
        a, b = rng.normal(size=(60, 33)) * scale, rng.normal(size=(80, 33))
        a[3], b[4] = 0, 0
        a[3, 5], b[4, 5] = scale, -2
        (p, s, e, n), (q, t, f, _) = neighbours.quantised(a), neighbours.quantised(b)
        true = (a / scale) @ b.T / np.linalg.norm(a / scale, axis=1)[:, None] / np.linalg.norm(b, axis=1)
        rough = (p.astype(int) @ q.astype(int).T) * s[:, None] * t
        assert (np.abs(true - rough) <= e[:, None] + n[:, None] * f + 1e-9).all()


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATES", 7)
    monkeypatch.setattr(neighbours, "QUERIES", 3)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(9)]  # ties
    rows += [(70, None), (71, []), (72, [0.0] * 6), (73, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (74, [float("nan")] + [1.0] * 5), (75, [float("inf")] + [1.0] * 5), (None, rows[1][1]), (80, [1.0, 2.0]), (81, [2.0, 4.0]), (82, [1.0]), (3, [9.0] * 6), (4, rows[4][1])]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, block int, rank int")
    queries = vectors.where("vec_id % 5 = 0 OR vec_id IN (80, 82) OR vec_id IS NULL")
    got = answer(neighbours.nearest(vectors, queries, 5))
    assert got == near(brute(rows, [i for i, _ in rows if i is not None and (i % 5 == 0 or i in (80, 82))], 5))
    assert neighbours.nearest(vectors.limit(0), queries, 5).count() == 0 and neighbours.nearest(vectors, queries.limit(0), 5).count() == 0


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert answer(QUERIES["op5_neighbours"](spark, FOLDER)) == near(brute(rows, [i for i, _ in rows if i % 50 == 0], 5))


def test_tables_meet_without_a_join(spark, monkeypatch, plan_of):
    """No side is broadcast or paired off by a join, however the sizes are judged; rows move as often as there are groups."""
    monkeypatch.setattr(neighbours, "CANDIDATES", 8)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    monkeypatch.setattr(neighbours, "HELD", 60)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(300)] + [(7, [0.5] * 6)] * 9 + [(400 + i, [1.0, float(i)]) for i in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    queries = vectors.where("vec_id % 9 = 0 OR vec_id = 7")
    found = neighbours.nearest(vectors, queries, 5)
    assert answer(found) == near(brute(rows, [i for i, _ in rows if i % 9 == 0 or i == 7], 5))
    plan = plan_of(found, run=True)
    assert "Join" not in plan and "Broadcast" not in plan
