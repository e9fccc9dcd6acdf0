"""Whitening of embeddings along the leading components of their covariance.

Vectors become whole numbers x = floor(1024 c) + 100000, so their count and sums
are exact, and a row is centred exactly (n x - sum, a whole number) before it
is multiplied with anything. The covariance itself is never formed: blocks of
centred rows are reduced by QR to triangles, triangles are stacked and reduced
again sixteen at a time by groups in Spark until one is left. That triangle, as
many numbers as the square of the dimension, is made bidiagonal by Householder
reflections; dqds finds the squares of its singular values to full relative
accuracy; twisted factorisations give their vectors, from which the reflections
lead back to the directions.

Cases: vectors that are null or empty or hold null or non-finite entries are
dropped. Should lengths differ, the most frequent one counts (of equally
frequent ones the longer) and vectors of other lengths are dropped too. Rows
with a null or repeated vec_id take part as they are. Components without
variance (fewer rows than dimensions, constant dimensions) have null whitened
values; explained is 0 there, and null if no component has variance. A
deviation beyond a bigint is null. An empty table gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import cut_lineage

SCALE, SHIFT = 1024, 100_000
FAN = 16  # triangles reduced together
EPS = float(np.finfo(float).eps)


def whole_numbers(batch: pa.RecordBatch) -> np.ndarray:
    """The x-vectors of a batch whose vectors are of one length."""
    flat = np.asarray(batch.column("embedding").flatten(), np.float64)
    return (np.floor(SCALE * flat) + SHIFT).astype(np.int64).reshape(batch.num_rows, -1)


def lifted(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - sums, exact; Python's integers where 64 bits could overflow."""
    largest = max(int(np.abs(x).max(initial=0)), 1)
    wide = n * largest + int(np.abs(sums).max(initial=0)) >= 1 << 62
    return x.astype(object) * n - sums.astype(object) if wide else x * n - sums


def deviations(y: np.ndarray) -> pa.Array:
    """Sum of squares of each row of whole numbers, null beyond a bigint."""
    if y.dtype != object and float(np.abs(y).max(initial=0)) ** 2 * max(y.shape[1], 1) < 2.0**62:
        return pa.array((y * y).sum(1), pa.int64())
    exact = [sum(int(v) ** 2 for v in row) for row in y]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of U' r V, and V, by Householder reflections."""
    a, d = r.copy(), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if not np.linalg.norm(x[1:]):
            return None
        w = x.copy()
        w[0] += np.copysign(size, x[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        if (w := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k + 1 < d and (w := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step; also the d's, of which none is negative if the shift was not too large."""
    d, seen, top, off = q[0] - shift, [], [], []
    for i in range(len(e)):
        seen.append(d)
        top.append(d + e[i])
        ratio = q[i + 1] / top[i] if top[i] else 0.0
        off.append(e[i] * ratio)
        d = (d * ratio if top[i] else q[i + 1]) - shift
    return [*top, d], off, [*seen, d]


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squares of the singular values of an upper bidiagonal matrix by dqds, largest first.

    Shifts are Newton's bound: the d's of a step without shift are the inverse
    diagonal of the inverse, so one over the sum of their inverses is never
    above the smallest value.
    """
    found: list[float] = []
    blocks = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        split = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS**2 * (q[i] + q[i + 1] + moved)), None)
        if split is not None:
            blocks += [(q[: split + 1], e[:split], moved), (q[split + 1 :], e[split + 1 :], moved)]
            continue
        if len(q) == 1:
            found.append(max(q[0], 0.0) + moved)
            continue
        if 1.5 * q[0] < q[-1]:  # read from its other end the matrix has the same values; the small end goes last
            q, e = q[::-1], e[::-1]
        q, e, seen = _dqds(q, e, 0.0)
        bound = 0.0 if min(seen) <= 0 else 1.0 / sum(1.0 / x for x in seen)
        shift = bound * (1 - 4 * EPS * len(q))
        while shift > 0:
            tried = _dqds(q, e, shift)
            if min(tried[2]) >= 0:
                q, e, moved = tried[0], tried[1], moved + shift
                break
            shift = shift / 2 if shift > EPS * bound else 0.0
        blocks.append((q, e, moved))
    return sorted(found, reverse=True)


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float, start: np.ndarray | None = None) -> np.ndarray:
    """Eigenvector of B'B (B upper bidiagonal a, b) for an eigenvalue, by the twisted factorisation of the least gamma.

    With `start`, one step of inverse iteration from there by the same factorisation.
    """
    n, q, e, ab = len(a), a * a, b * b, a[:-1] * b
    tiny = EPS * EPS * max(value, float(q.max()), 1e-300)
    s, down = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n):
        down[i] = s[i] + q[i] or tiny
        if i + 1 < n:
            s[i + 1] = e[i] * s[i] / down[i] - value
    p, up = np.empty(n), np.empty(n)
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = e[i] + p[i + 1] or tiny
        p[i] = p[i + 1] * q[i] / up[i + 1] - value
    gamma = s + p + value
    k = int(np.argmin(np.abs(gamma)))
    x = np.zeros(n)
    if start is None:
        x[k] = 1.0
    else:  # N D N' x = start, N unit lower above the twist and unit upper below it
        w = start.copy()
        for i in range(k):
            w[i + 1] -= ab[i] / down[i] * w[i]
        for i in range(n - 1, k, -1):
            w[i - 1] -= ab[i - 1] / up[i] * w[i]
        x = np.where(np.arange(n) < k, w / down, w / np.where(np.arange(n) > k, np.append(1.0, up[1:]), 1.0))
        x[k] = w[k] / (gamma[k] or tiny)
    for i in range(k - 1, -1, -1):
        x[i] -= ab[i] / down[i] * x[i + 1]
    for i in range(k, n - 1):
        x[i + 1] -= ab[i] / up[i + 1] * x[i]
    return x / np.linalg.norm(x)


def _apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            x = x - (o @ x) * o
    return x


def leading_components(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest squared singular values of r, largest first, and their right vectors as columns."""
    d = r.shape[1]
    size = float(np.abs(r).max(initial=0.0)) or 1.0
    a, b, v = bidiagonal(np.vstack([r, np.zeros((max(d - len(r), 0), d))])[:d] / size)
    cut = np.flatnonzero(np.abs(b) <= EPS * np.abs(a).max(initial=0.0)) + 1
    pairs = []
    for lo, hi in zip([0, *cut], [*cut, d], strict=True):
        top, off = a[lo:hi], b[lo : hi - 1]
        pairs += [(value, lo, hi) for value in squared_singular_values(top, off)]
    pairs = sorted(pairs, key=lambda p: (-p[0], p[1]))[:count]
    vectors: list[np.ndarray] = []
    random = np.random.default_rng(0)
    for i, (value, lo, hi) in enumerate(pairs):
        close = [vectors[j][lo:hi] for j, (other, l, _) in enumerate(pairs[:i]) if l == lo and other - value <= 1e-3 * pairs[0][0]]
        z = twisted_vector(a[lo:hi], b[lo : hi - 1], value)
        if close:
            z = _apart(z, close)
            while (size_z := np.linalg.norm(z)) < 0.1:
                z = _apart(twisted_vector(a[lo:hi], b[lo : hi - 1], value, _apart(random.standard_normal(hi - lo), close)), close)
            z = z / size_z
        whole = np.zeros(d)
        whole[lo:hi] = z
        vectors.append(whole)
    found = v @ np.array(vectors).T if vectors else np.empty((d, 0))
    for j in range(found.shape[1]):  # either sign is right; the same one every time
        if found[np.argmax(np.abs(found[:, j])), j] < 0:
            found[:, j] = -found[:, j]
    return np.array([p[0] for p in pairs]) * size * size, found


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows whose vector can take part."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)


def _sums(rows: DataFrame) -> DataFrame:
    """d, n, place, total: one row per batch, length and dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column("embedding").value_lengths())
            for d in np.unique(lengths):
                x = whole_numbers(batch.filter(pa.array(lengths == d)))
                yield pa.RecordBatch.from_pydict({"d": np.full(d, d, np.int32), "n": np.full(d, len(x), np.int64), "place": np.arange(d, dtype=np.int32), "total": x.sum(0)})

    return rows.mapInArrow(work, "d int, n bigint, place int, total bigint").groupBy("d", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _triangle(rows: DataFrame, d: int, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the QR decomposition of all centred rows."""

    def reduced(parts: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.vstack(parts), mode="r")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, d))
        for batch in batches:
            if batch.num_rows:
                held = reduced([held, (lifted(whole_numbers(batch), n, sums) / n).astype(np.float64)])
        if len(held):
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "r": [held.tobytes()]}, pa.schema([("part", pa.int64()), ("r", pa.binary())]))

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        parts = [np.frombuffer(b, np.float64).reshape(-1, d) for b in group.column("r").to_pylist()]
        return pa.table({"part": pa.array([group.column("part")[0].as_py() // FAN], pa.int64()), "r": pa.array([reduced(parts).tobytes()], pa.binary())})

    held = cut_lineage(rows.mapInArrow(work, "part bigint, r binary"))
    last = held.agg(F.max("part")).first()[0]
    while last > 0:
        held = cut_lineage(held.groupBy(F.expr(f"part div {FAN}")).applyInArrow(merge, "part bigint, r binary"))
        last //= FAN
    return np.frombuffer(held.first()["r"], np.float64).reshape(-1, d)


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and leading component."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    rows = usable(vectors)
    totals = cut_lineage(_sums(rows))
    common = totals.where("place = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    d, n = common["d"], int(common["n"])
    sums = np.array([r["total"] for r in totals.where(F.col("d") == d).orderBy("place").collect()], np.int64)
    rows = rows.where(F.size("embedding") == d)
    r = _triangle(rows, d, n, sums)
    trace = float((r * r).sum())
    values, directions = leading_components(r, min(components, d))
    live = values > d * EPS * EPS * max(n, d) * trace
    scales = np.where(live, np.sqrt(np.where(live, values, 1.0) / n), np.nan)
    share = values * live / trace if trace else np.full(len(values), np.nan)

    def whitened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        y = lifted(whole_numbers(batch), n, sums)
        return y, (y / n).astype(np.float64) @ directions / scales

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = np.hstack([whitened(batch)[1], np.ones((batch.num_rows, 1))])
            total += w.T @ w
        place = np.arange((k + 1) ** 2)
        yield pa.RecordBatch.from_pydict({"place": place, "total": total.ravel()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            y, w = whitened(batch)
            m, each = batch.num_rows, pa.array(np.repeat(np.arange(batch.num_rows), k))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(each), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m), "n": np.full(m * k, n, np.int64),
                "deviation": deviations(y).take(each), "whitened": pa.array(w.ravel(), mask=np.isnan(w.ravel())),
                "explained": pa.array(np.tile(share, m), mask=np.isnan(np.tile(share, m))), "identity_error": pa.array(np.full(m * k, error), mask=np.full(m * k, np.isnan(error))),
            })

    second = rows.mapInArrow(moments, "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total")).orderBy("place").collect()
    square = np.array([m["total"] for m in second]).reshape(len(values) + 1, -1)
    covariance = square[:-1, :-1] / n - np.outer(square[:-1, -1], square[:-1, -1]) / n / n
    off = np.abs(covariance - np.eye(len(values)))[np.ix_(live, live)]
    error = float(off.max()) if off.size else float("nan")
    return rows.mapInArrow(work, schema)
