"""Quality classifier: regularised quadratic discriminant on document statistics.

Every text gives `STATISTICS`, transformed to logarithms of smoothed ratios. Each class has
a normal density whose covariance is shrunk towards the pooled covariance and towards
its own mean variance; the Cholesky factor, its log-determinant and the mean are computed
once and sent with the tasks. The score is the difference of the two Mahalanobis
log-densities and priors, passed through a logistic curve fitted to the training rows.

The class moments are sums over all labelled training rows, added up by Spark; the
curve is fitted to histograms of their scores. Null text is the empty text and gets a
score like any other; rows with null id are scored and never learned from; labels other
than 0 and 1, null labels, and ids with both labels are not learned from. If a class has no labels, the
score is the share of label 1 (0.5 without any). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import store
from docsift.llm.pretoken import chunked

STATISTICS = (
    "characters words word_length word_spread upper digits space stops marks signs bars bangs accents "
    "word_ends sign_ends capitals distinct_words lines distinct_lines closed_lines entropy"
).split()
TO_POOLED, TO_SPHERE = 0.2, 0.05  # shares of the pooled and of the spherical covariance
THRESHOLD = 0.3
BINS = 400


def _set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _LOWER, _DIGIT = _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _set("abcdefghijklmnopqrstuvwxyz"), _set("0123456789")
_SPACE, _STOP, _MARK = _set(" \t\n\v\f\r"), _set("."), _set(",;:'\"()-?")
_BAR, _BANG = _set("|"), _set("!")
_HIGH = np.arange(256) >= 128
_LEAD = np.arange(256) >= 192
_SIGN = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _STOP | _MARK | _HIGH)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of `STATISTICS` a text."""
    n = len(texts)
    hist = np.zeros((n, 256))
    words, length, square, ends, sign_ends, capitals = np.zeros((6, n))
    for numbers, group in chunked(texts):
        parts = [t.encode() for t in group]
        data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        of = np.repeat(numbers, [len(p) + 1 for p in parts])
        low = int(numbers[0])
        rows = int(numbers[-1]) - low + 1
        hist[low : low + rows] += np.bincount((of - low) * 256 + data, minlength=rows * 256).reshape(rows, 256)
        np.add.at(hist, (numbers, 10), -1)
        edges = np.flatnonzero(np.diff((~_SPACE[data]).astype(np.int8), prepend=0))
        first, after = edges[::2], edges[1::2]
        whose, size, last = of[first], after - first, data[after - 1]
        for total, weight in (
            (words, None),
            (length, size),
            (square, size * size),
            (ends, _STOP[last] | _MARK[last]),
            (sign_ends, _SIGN[last]),
            (capitals, _UPPER[data[first]]),
        ):
            total += np.bincount(whose, weight, minlength=n)
    lines, distinct_lines, closed, distinct = np.zeros((4, n))
    for i, text in enumerate(texts):
        split = text.split("\n")
        lines[i], distinct_lines[i] = len(split), len(set(split))
        closed[i] = sum(line.endswith((".", "?", "!", '"')) for line in split)
        distinct[i] = len(set(text.split()))
    chars = hist.sum(axis=1) - hist[:, 128:192].sum(axis=1)

    def share(part, whole):
        return np.log((part + 0.5) / (whole + 1.0))

    def count(chosen):
        return hist[:, chosen].sum(axis=1)

    letters = count(_UPPER) + count(_LOWER) + count(_LEAD)
    p = hist / np.maximum(1, hist.sum(axis=1))[:, None]
    entropy = -(p * np.log(np.where(p > 0, p, 1))).sum(axis=1)
    mean = length / np.maximum(1, words)
    spread = np.sqrt(np.maximum(0, square / np.maximum(1, words) - mean * mean))
    return np.column_stack(
        [np.log1p(chars), np.log1p(words), np.log1p(mean), np.log1p(spread), share(count(_UPPER), letters)]
        + [share(count(x), chars) for x in (_DIGIT, _SPACE, _STOP, _MARK, _SIGN, _BAR, _BANG, _LEAD)]
        + [share(x, words) for x in (ends, sign_ends, capitals, distinct)]
        + [np.log1p(lines), share(distinct_lines, lines), share(closed, lines), entropy]
    )


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and constants of two classes, and the curve."""

    mean: np.ndarray
    factor: np.ndarray
    constant: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    share: float | None = None  # the score of all, if a class is missing

    def margin(self, x: np.ndarray) -> np.ndarray:
        # Sums row by row: a matrix product rounds a row by its place, and equal texts should score the same.
        density = [
            c - 0.5 * sum(((x - m) * row).sum(axis=1) ** 2 for row in f)
            for m, f, c in zip(self.mean, self.factor, self.constant, strict=True)
        ]
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        z = np.clip(self.slope * np.cbrt(self.margin(x)) + self.shift, -35, 35)
        return 1 / (1 + np.exp(-z))


def _rows(texts: list[str], step: int = 500) -> Iterator[tuple[int, np.ndarray]]:
    for i in range(0, len(texts), step):
        yield i, statistics(texts[i : i + step])


def measured(docs: DataFrame) -> DataFrame:
    """`doc_id, x`: the statistics of every row of `docs(doc_id, text)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            x = [r for _, part in _rows(texts) for r in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(STATISTICS))


def _moments(train: DataFrame) -> dict[int, np.ndarray]:
    """Per class: number, sums and sums of products, over all rows of `train(x, y)`."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x, y = _matrix(batch.column(0)), batch.column(1).to_numpy()
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        y, at = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(y.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total.ravel())], names=["y", "at", "v"]
        )

    parts = train.select("x", "y").mapInArrow(run, "y int, at int, v double")
    out = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for row in parts.groupBy("y", "at").agg(F.sum("v").alias("v")).collect():  # 2 (1 + d + d * d) rows
        out[row["y"]][row["at"]] = row["v"]
    return out


def _discriminant(moments: dict[int, np.ndarray]) -> Discriminant:
    d = len(STATISTICS)
    n = np.array([moments[k][0] for k in (0, 1)])
    if n.min() < 2:
        return Discriminant(*np.zeros((3, 1)), share=float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = np.array([moments[k][1 : d + 1] / n[k] for k in (0, 1)])
    cov = [moments[k][d + 1 :].reshape(d, d) / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
    factor, constant = [], []
    for k in (0, 1):
        mixed = ((1 - TO_POOLED) * cov[k] + TO_POOLED * pooled) / np.outer(scale, scale)
        sphere = np.trace(mixed) / d + 1e-6
        mixed = (1 - TO_SPHERE) * mixed + TO_SPHERE * sphere * np.eye(d)
        lower = np.linalg.cholesky(mixed)
        factor.append(np.linalg.inv(lower) / scale)
        constant.append(np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(mean, np.array(factor), np.array(constant))


def _calibrated(model: Discriminant, train: DataFrame) -> Discriminant:
    """Slope and shift of the logistic curve over the cube root of the margin."""
    edge = 40.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS))
        for batch in batches:
            z = np.cbrt(model.margin(_matrix(batch.column(0))))
            at = np.clip((z + edge) / (2 * edge) * BINS, 0, BINS - 1).astype(int)
            np.add.at(total, (batch.column(1).to_numpy(), at), 1)
        y, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(y.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total[y, at])], names=["y", "at", "n"]
        )

    rows = train.select("x", "y").mapInArrow(run, "y int, at int, n double")
    rows = rows.groupBy("y", "at").agg(F.sum("n").alias("n")).collect()  # 2 BINS rows at most
    z = np.array([(r["at"] + 0.5) / BINS * 2 * edge - edge for r in rows])
    y = np.array([r["y"] for r in rows], float)
    w = np.array([r["n"] for r in rows])
    design = np.column_stack([z, np.ones_like(z)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -35, 35)))
        gradient = design.T @ (w * (y - p)) - np.array([0.01 * (beta[0] - 1), 0.01 * beta[1]])
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.shift = float(max(beta[0], 1e-3)), float(beta[1])
    return model


def fit(spark: SparkSession, rows: DataFrame, labels: DataFrame) -> Discriminant:
    """The model from `rows(doc_id, x)` and `labels(doc_id, y)`."""
    known = labels.where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id")
    known = known.agg(F.min("y").cast("int").alias("y"), F.max("y").alias("top")).where("y = top")
    train = store.keep(spark, rows.join(known, "doc_id").select("x", "y"), "quality-train")
    model = _discriminant(_moments(train))
    return model if model.share is not None else _calibrated(model, train)


def fold(doc_id: str = "doc_id", parts: int = 5):
    return F.crc32(F.col(doc_id).cast("string")) % parts


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """`doc_id, score, predicted` of rows with statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            predicted = pa.array((score >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), predicted], names=["doc_id", "score", "predicted"]
            )

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of `docs`, all columns, that a model fitted to `labels(doc_id, y)` accepts."""
    model = fit(spark, measured(store.text_of(docs, text_col=text_col)), labels)
    at = store.place(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            good = [g for _, part in _rows(texts) for g in (model.score(part) >= THRESHOLD).tolist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    rows = store.numbered(docs)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
