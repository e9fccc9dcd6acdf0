"""Language identification by interpolated Kneser-Ney character models.

Every language has a model of character n-grams up to `ORDER`. Texts are lower-
cased and each run of characters that are no letters becomes one space. The
models of all languages share one set of sorted hash arrays per order: a row of
the array holds the log probability of that n-gram under every language, and a
second pair of arrays the back-off weight of every context. A text takes the
language of lowest cross-entropy per character.

Rejection is calibrated on sampled documents that the counts have not seen: a
text is rejected when its cross-entropy lies above the median of its language by
more than `SLACK` bits and `TAIL` times the largest deviation seen there, which
shrinks with the root of the length. Calibration rows that cost less in another
language than in that of their label are left out, and so are deviations of more
than `FENCE` times the `USUAL` quantile: a few mixed, wrongly labelled or garbled
rows do not move the limit.

The fit uses a bounded sample, about `SAMPLE` labelled rows a language, chosen
by a hash of doc_id from all rows of that language, whole texts. One in
`CALIBRATION` of them calibrates instead of being counted.

Cases: a null text, or one without letters, is `und` with score 0, rejected.
Rows without lang or doc_id teach nothing; without any labelled row everything
is `und`. A null doc_id is predicted like any other and is not held out. Equal
cross-entropies go to the language that sorts first. Repeated rows get the same
prediction. The input's other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.batches import small_batches

ORDER = 4
SAMPLE = 1500
CALIBRATION = 5
SLACK, TAIL = 1.0, 3.0
USUAL, FENCE = 0.9, 5.0
PRIME = 0x9E3779B97F4A7C15
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def codes(texts: list[str | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Cleaned code points of all texts, each after `order - 1` spaces, and the number of those that count."""
    lowered = [(t or "").lower() for t in texts]
    raw = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    starts = np.cumsum(lengths) - lengths
    letter = letters()[raw]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    first = starts[lengths > 0]
    keep[first] = letter[first]  # white space before a text is not kept
    kept = np.append(0, np.cumsum(keep))
    counts = kept[starts + lengths] - kept[starts]
    out = np.full(int(counts.sum()) + len(texts) * (order - 1), 32, np.uint64)
    row = np.repeat(np.arange(len(texts)), counts)
    out[np.arange(len(row)) + (row + 1) * (order - 1)] = np.where(letter, raw, 32)[keep]
    return out, counts


def hashes(seq: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` codes that end at each place (from `size - 1` on)."""
    n = len(seq) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for back in range(size):
        total += (seq[size - 1 - back : size - 1 - back + n] + np.uint64(1)) * np.uint64(pow(PRIME, back, 1 << 64))
    total ^= total >> np.uint64(31)
    return total * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Models:
    """grams[k], logs[k]: sorted hashes and log2 probabilities of the k-grams; contexts[k], backs[k]: of their contexts."""

    languages: list[str]
    grams: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    backs: dict[int, np.ndarray]
    unseen: float
    limits: np.ndarray | None = None  # per language: median and largest usual scaled deviation of the cross-entropy

    def log_probabilities(self, seq: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log2 P of the code at each place of `ends`, given the codes before it, under each language."""
        out = np.zeros((len(ends), len(self.languages)), np.float32)
        open_ = np.arange(len(ends))
        for size in range(max(self.grams), 0, -1):
            key = hashes(seq, size)[ends[open_] - (size - 1)]
            at, found = _find(self.grams[size], key)
            out[open_[found]] += self.logs[size][at[found]]
            open_ = open_[~found]
            if not len(open_):
                return out
            if size > 1:
                at, found = _find(self.contexts[size], hashes(seq, size - 1)[ends[open_] - (size - 1)])
                out[open_[found]] += self.backs[size][at[found]]
        out[open_] += self.unseen
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and the characters counted."""
        order = max(self.grams)
        seq, counts = codes(texts, order)
        total = np.zeros((len(texts), len(self.languages)))
        row = np.repeat(np.arange(len(texts)), counts)
        ends = np.arange(len(row)) + (row + 1) * (order - 1)
        step = 1 << 20
        for a in range(0, len(ends), step):  # long texts in pieces, so that memory stays bounded
            logs = self.log_probabilities(seq[ends[a] - order + 1 : ends[min(a + step, len(ends)) - 1] + 1], ends[a : a + step] - ends[a] + order - 1)
            of = row[a : a + step]
            begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            total[of[begins]] -= np.add.reduceat(logs.astype(np.float64), begins, axis=0)
        return total / np.maximum(counts, 1)[:, None], counts


def _find(sorted_: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
    return at, sorted_[at] == keys


def kneser_ney(languages: list[str], grams: np.ndarray, counts: np.ndarray) -> Models:
    """Models from the n-grams (one row of codes each) and their counts in each language."""
    order, width = grams.shape[1], len(languages)
    types, tallies = {order: grams}, {order: counts.astype(np.float64)}
    suffix: dict[int, np.ndarray] = {}
    for size in range(order, 1, -1):  # lower orders count the different left neighbours
        types[size - 1], suffix[size] = np.unique(types[size][:, 1:], axis=0, return_inverse=True)
        suffix[size] = suffix[size].reshape(-1)
        tallies[size - 1] = np.zeros((len(types[size - 1]), width))
        np.add.at(tallies[size - 1], suffix[size], tallies[size] > 0)
    found = Models(languages, {}, {}, {}, {}, 0.0)
    lower = np.full((1, width), 1 / (len(types[1]) + 1))
    found.unseen = float(np.log2(lower[0, 0]))
    for size in range(1, order + 1):
        tally = tallies[size]
        contexts, of = np.unique(types[size][:, :-1], axis=0, return_inverse=True)
        of = of.reshape(-1)
        total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, of, tally)
        np.add.at(kinds, of, tally > 0)
        once, twice = (tally == 1).sum(0), (tally == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        below = lower[suffix[size]] if size > 1 else lower[np.zeros(len(tally), int)]
        probability = np.where(total[of] > 0, np.maximum(tally - discount, 0) / np.maximum(total[of], 1), 0.0) + back[of] * below
        key = hashes_of(types[size])
        by = np.argsort(key)
        found.grams[size], found.logs[size] = key[by], np.log2(probability[by]).astype(np.float32)
        if size > 1:
            key = hashes_of(contexts)
            by = np.argsort(key)
            found.contexts[size], found.backs[size] = key[by], np.log2(back[by]).astype(np.float32)
        lower = probability
    if 1 in found.grams:  # a code no language has seen: the mass the unigrams leave
        found.unseen += float(np.log2(back_mass(tallies[1])))
    return found


def back_mass(tally: np.ndarray) -> float:
    """Share that the discounted unigrams leave for codes never seen, at most a half."""
    return float(np.clip(0.5 * (tally > 0).sum() / max(tally.sum(), 1), 1e-6, 0.5))


def hashes_of(rows: np.ndarray) -> np.ndarray:
    """The hash of `hashes` for each row of codes."""
    return np.concatenate([hashes(np.ascontiguousarray(rows[a : a + 65536]).reshape(-1), rows.shape[1])[:: rows.shape[1]] for a in range(0, len(rows), 65536)]) if len(rows) else np.empty(0, np.uint64)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, lang, text and the calibration flag of about `sample` rows a language."""
    usable = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    rates = [(r.lang, sample / r.n) for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, rate in rates:
        chosen = chosen | ((F.col("lang") == lang) & (place < int(rate * (1 << 30))))
    return usable.where(chosen).withColumn("calibrates", F.pmod(F.xxhash64(F.lit("c"), "doc_id"), F.lit(CALIBRATION)) == 0)


def count_grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram (codes joined by blanks) and n over all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = np.array(batch.column("lang").to_pylist(), object), batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                seq, counts = codes([t for t, at in zip(texts, langs, strict=True) if at == lang], order)
                row = np.repeat(np.arange(len(counts)), counts)
                ends = np.arange(len(row)) + (row + 1) * (order - 1)
                if not len(ends):
                    continue
                _, first, n = np.unique(hashes(seq, order)[ends - (order - 1)], return_index=True, return_counts=True)
                grams = [seq[e - order + 1 : e + 1].astype("<u4").tobytes() for e in ends[first]]
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(n), "gram": pa.array(grams, pa.binary()), "n": n})

    return rows.select("lang", "text").mapInArrow(work, "lang string, gram binary, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, sample: int = SAMPLE, order: int = ORDER) -> Models | None:
    """Models of all languages in the labelled rows, with calibrated limits; None without such rows."""
    small_batches(docs.sparkSession)
    rows = sampled(docs, sample)
    table = count_grams(rows.where("NOT calibrates"), order).toArrow()
    if not table.num_rows:
        return None
    langs, which = np.unique(np.array(table.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    grams = np.frombuffer(b"".join(table.column("gram").to_pylist()), "<u4").reshape(-1, order).astype(np.uint64)
    types, row = np.unique(grams, axis=0, return_inverse=True)
    counts = np.zeros((len(types), len(langs)))
    counts[row.reshape(-1), which] = table.column("n").to_numpy()
    models = kneser_ney(list(langs), types, counts)
    seen = {lang: [] for lang in models.languages}
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, n = shared.value.entropies(batch.column("text").to_pylist())
            at = {lang: i for i, lang in enumerate(shared.value.languages)}
            own = [(x, b[at[x]], int(k)) for x, b, k in zip(batch.column("lang").to_pylist(), bits, n, strict=True) if x in at and k and b.argmin() == at[x]]
            yield pa.RecordBatch.from_pydict({"lang": [x[0] for x in own], "bits": pa.array([x[1] for x in own], pa.float64()), "n": pa.array([x[2] for x in own], pa.int64())}, schema=pa.schema([("lang", pa.string()), ("bits", pa.float64()), ("n", pa.int64())]))

    for r in rows.where("calibrates").select("lang", "text").mapInArrow(measure, "lang string, bits double, n bigint").collect():
        seen[r.lang].append((r.bits, r.n))
    models.limits = np.array([_limits(seen[lang]) for lang in models.languages])
    return models


def _limits(pairs: list[tuple[float, int]]) -> tuple[float, float]:
    """Median cross-entropy, and the largest usual deviation above it times the root of the length."""
    if not pairs:
        return np.inf, 0.0
    bits, n = np.array(pairs).T
    middle = float(np.median(bits))
    above = np.maximum((bits - middle) * np.sqrt(n), 0)
    return middle, float(above[above <= FENCE * np.quantile(above, USUAL, method="lower")].max())


def predict(docs: DataFrame, models: Models | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected and bits (per character, null for `und`) of every row."""
    docs = docs.select("doc_id", "text")
    if models is None:
        return docs.select("doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("bits"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            guess, score, rejected, bits = classify(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": guess, "score": score, "rejected": rejected, "bits": bits})

    out = docs.mapInArrow(work, "doc_id bigint, lang_pred string, score double, rejected boolean, bits double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected", "bits")


def classify(models: Models, texts: list[str | None]) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Language, score, rejection and bits per character of each text."""
    bits, n = models.entropies(texts)
    best = bits.argmin(1)
    own = bits[np.arange(len(bits)), best]
    score = 1 / np.exp2(-np.minimum((bits - own[:, None]) * np.sqrt(n)[:, None], 500)).sum(1)
    rejected = np.zeros(len(texts), bool)
    if models.limits is not None:
        middle, tail = models.limits[best].T
        rejected = own > middle + SLACK + TAIL * tail / np.sqrt(np.maximum(n, 1))
    none = n == 0
    guess = np.where(none, UNKNOWN, np.array(models.languages, object)[best])
    return pa.array(guess.tolist(), pa.string()), pa.array(np.where(none, 0.0, score)), pa.array(rejected | none), pa.array(own, mask=none)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Fit on the labelled rows of `docs` and predict all its rows."""
    return predict(docs, fit(docs, sample))


def keep_known(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs`, all columns, whose text is accepted as one of the learned languages."""
    models = fit(docs, sample)
    if models is None:
        return docs.limit(0)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    text = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = classify(shared.value, batch.column(text).to_pylist())[2]
            yield batch.filter(pc.invert(rejected))

    return docs.mapInArrow(work, docs.schema)
