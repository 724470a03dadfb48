"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are the TF-IDF weights of the one- to three-character sequences of letters and blanks
in the lower-case text, hashed to `BUCKETS`, of length one. Document frequencies are counted over all training
documents. Weights are learned by follow-the-regularised-leader with L1 and L2 penalties
(per-coordinate rates, exact zeros), and the softmax gets a temperature that minimises
the loss on a part of the sample that the weights have not seen.

The weights are fitted to a bounded sample of labelled texts, whole ones: `SAMPLE` documents in all
at most (one a language at least), as many of each language, the ones with the smallest hashes of id and text; equal
rows are told apart by nothing and are taken in any order, so that the weights do not depend on the partitions. Every text is scored whole. Null text and text without a letter is `und` with score 0;
without training rows everything is. Rows with null or repeated ids are scored like any other; rows with null
id or language are not learned from. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import store

BUCKETS, ORDERS = 1 << 16, 3
SAMPLE = 4000
EPOCHS, RATE, SMOOTH, L1, L2 = 4, 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"
_PART = 1 << 20
_LETTER = regex.compile(r"\p{L}")
_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; computed once a process."""
    if not _table:
        _table.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _table[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's character sequences, and how often each occurs. Runs of other
    characters than letters count as one blank, and as nothing before the first letter."""
    total = np.zeros(BUCKETS, np.int64)
    text = text.lower()
    tail, after_letter = np.zeros(0, np.uint32), False
    for begin in range(0, len(text), _PART):
        points = np.frombuffer(text[begin : begin + _PART].encode("utf-32-le"), np.uint32)
        letter = _letters()[points]
        before = np.concatenate([[after_letter], letter[:-1]])
        after_letter = letter[-1]
        keep = letter | before
        points = np.where(letter, points, np.uint32(32))[keep]
        skip = len(tail)
        points = np.concatenate([tail, points])
        tail = points[max(0, len(points) - ORDERS + 1) :]
        key = points * np.uint32(0x9E3779B1)
        for order in range(1, ORDERS + 1):
            if order > 1:
                if len(key) < 2:
                    break
                key = (key[:-1] ^ (key[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + points[order - 1 :]
            fresh = key[max(0, skip - order + 1) :]
            mixed = (fresh ^ (fresh >> np.uint32(13))) * np.uint32(0xC2B2AE3D)
            total += np.bincount(mixed >> np.uint32(16), minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[grams(text)[0]] += 1
                total[BUCKETS] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    parts = train.select("text").mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS + 1, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS + 1 rows
        out[row["bucket"]] = row["n"]
    return out[:BUCKETS], int(out[BUCKETS])


@dataclass
class Model:
    names: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    temperature: float = 1.0

    def vector(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        x = count * self.idf[found]
        return x / max(np.sqrt((x * x).sum()), 1e-12)

    def probabilities(self, text: str) -> np.ndarray:
        found, count = grams(text)
        return softmax(self.vector(found, count) @ self.weights[found] / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0
        p = self.probabilities(text)
        best = int(p.argmax())
        return self.names[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int) -> np.ndarray:
    """Weights after `EPOCHS` passes; only the coordinates of a text are touched by it."""
    z, n = np.zeros((2, BUCKETS, k))

    def weights(zi, ni):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1, 0)
        return -shrunk / ((SMOOTH + np.sqrt(ni)) / RATE + L2)

    for _ in range(EPOCHS):
        for (at, x), label in zip(vectors, y, strict=True):
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error[None, :]
            g2 = g * g
            z[at] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / RATE * w
            n[at] = ni + g2
    return weights(z, n)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    if not len(y):
        return 1.0
    scale = np.exp(np.linspace(np.log(0.02), np.log(5), 200))
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in scale]
    return float(scale[int(np.argmin(loss))])


def _smallest(train: DataFrame, sizes: dict[str, int], each: int) -> dict[str, int]:
    """For every language the hash up to which `each` rows lie (all rows, if there are fewer).

    Only hashes below a multiple of the expected bound are gathered, with counts; the multiple grows where equal rows
    leave too few different hashes below it.
    """
    low, high = -(1 << 63), (1 << 63) - 1
    bounds, factor = {}, 3
    hashes = train.select("lang", F.xxhash64("doc_id", "text").alias("rank"))
    while len(bounds) < len(sizes):
        left = {n: min(1.0, factor * each / size) for n, size in sizes.items() if n not in bounds}
        below = F.create_map(*(x for n, share in left.items() for x in (F.lit(n), F.lit(min(high, low + int(share * (1 << 64)))))))
        some = hashes.where(F.col("lang").isin(*left)).where(F.col("rank") <= below[F.col("lang")])
        taken = dict.fromkeys(left, 0)
        for r in sorted(some.groupBy("lang", "rank").agg(F.count("*").alias("n")).collect(), key=lambda r: r["rank"]):
            taken[r["lang"]] += r["n"]
            if taken[r["lang"]] >= each:
                bounds.setdefault(r["lang"], r["rank"])
        bounds |= {n: high for n, share in left.items() if n not in bounds and share == 1.0}
        factor *= 8
    return bounds


def fit(spark: SparkSession, train: DataFrame) -> Model:
    """The model from `train(doc_id, text, lang)`."""
    train = train.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    frequency, total = document_frequencies(train)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Model([], idf, np.zeros((BUCKETS, 0)))
    each = max(1, SAMPLE // len(names))
    bounds = _smallest(train, sizes, each)
    rank = F.xxhash64("doc_id", "text")
    bound = F.create_map(*(x for n in names for x in (F.lit(n), F.lit(bounds[n]))))
    # Rows of equal hash are one row with a count: a row that is repeated without end comes once a task.
    sample = train.withColumn("rank", rank).where(F.col("rank") <= bound[F.col("lang")])
    sample = sample.groupBy("lang", "rank").agg(F.first("text").alias("text"), F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array([f.astype("<u2").tobytes() for f, _ in found], pa.binary()),
                    pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
                ],
                names=["rank", "lang", "n", "found", "count"],
            )

    kept = sample.select("rank", "text", "lang", "n").mapInArrow(run, "rank long, lang string, n long, found binary, count binary")
    rows, taken = [], dict.fromkeys(names, 0)
    for r in sorted(kept.collect(), key=lambda r: (r["rank"], r["lang"])):  # SAMPLE rows at most, or one a language
        some = min(r["n"], each - taken[r["lang"]])
        taken[r["lang"]] += some
        rows += [r] * some
    model = Model(names, idf, np.zeros((BUCKETS, len(names))))
    vectors = []
    for r in rows:
        found = np.frombuffer(r["found"], "<u2").astype(np.int64)
        vectors.append((found, model.vector(found, np.frombuffer(r["count"], "<u4").astype(np.int64))))
    y = np.array([names.index(r["lang"]) for r in rows])
    later = np.arange(len(rows)) % 5 == 4
    seen = np.flatnonzero(~later)
    model.weights = ftrl([vectors[i] for i in seen], y[seen], len(names))
    held = np.flatnonzero(later)
    logits = np.array([vectors[i][1] @ model.weights[vectors[i][0]] for i in held]).reshape(-1, len(names))
    model.temperature = _temperature(logits, y[held])
    return model


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, lang_pred, score` of every row of `docs(doc_id, text)`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
