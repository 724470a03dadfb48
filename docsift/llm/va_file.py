"""Exact top-k by inner product with a vector-approximation file.

Components are whole numbers. The file holds, in blocks, for every vector one byte a
component: its cell among 256 equal ones between the smallest and the largest value of that component.
The edges of the cells bound every inner product from below and above.

A first scan of the cells gives each query a threshold: a score that k vectors reach for
certain. A second scan of the cells takes the vectors whose upper bound is not below it, and reads the exact
components of those alone, which lie in files beside, in the order of the bounds, until the next bound is
below the k-th score. A task
holds its partition of the file and one block of queries at a time, which it reads from the shared folder,
so that the queries need not fit anywhere. Ties go to the smaller id.

Vectors that are null, or hold a null or a non-finite component, take no part; vectors are compared
with queries of their own length; a row is no candidate of a query with its id, and
rows that share an id are candidates each; null ids take no part. Scores beyond a long are
cut to its range. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm import store

CELLS = 256
VECTORS, QUERIES = 1024, 512  # in a block
NEAR = 4  # exact vectors so many places apart are read together
_LONG = (1 << 63) - 1


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """`vec_id, v`: rows that take part, components as floor(scale * x)."""
    ok = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ok)
    v = F.transform(vector_col, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and component matrix of the vectors of each length."""
    ids = batch.column(0).to_numpy()
    lists = batch.column(1)
    sizes = lists.value_lengths().to_numpy()
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        part = lists.take(pa.array(at))
        yield ids[at], part.flatten().to_numpy().reshape(len(at), n)


def ranges(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors the smallest and largest value of every component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, m in _by_length(batch):
                n = m.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, n, np.int32)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(m.min(axis=0)),
                        pa.array(m.max(axis=0)),
                    ],
                    names=["n", "at", "low", "high"],
                )

    parts = vectors.mapInArrow(run, "n int, at int, low long, high long")
    rows = parts.groupBy("n", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    out = {0: (np.zeros(0, np.int64), np.zeros(0, np.int64))}
    for r in rows:  # one a component
        low, high = out.setdefault(r["n"], (np.zeros(r["n"], np.int64), np.zeros(r["n"], np.int64)))
        low[r["at"]], high[r["at"]] = r["low"], r["high"]
    return out


def _steps(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Width of the cells of each component, so that 256 of them cover its range."""
    span = high.astype(object) - low.astype(object)
    return np.array([int(s) // CELLS + 1 for s in span], np.int64)


def cells(m: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return ((m - low) // _steps(low, high)).astype(np.uint8)


def edges(cell: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest components that the cells allow."""
    step = _steps(low, high)
    begin = low + cell.astype(np.int64) * step
    return begin, np.minimum(begin + step - 1, high)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, cut to the range of a long."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = max(abs(int(a.min())), abs(int(a.max()))) * max(abs(int(b.min())), abs(int(b.max()))) * a.shape[1]
    if most < 1 << 53:  # doubles hold every partial sum exactly
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


def approximation_file(spark: SparkSession, vectors: DataFrame, bounds) -> DataFrame:
    """Blocks of the file: length, ids, cells, and where the exact components of the block begin.
    Those lie in files of their own beside it, so that a scan of the cells reads none of them."""
    base = store.folder(spark, "va-exact")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{base}/exact-{uuid.uuid4().hex}"  # of this attempt; only the blocks of a finished one name it
        out, offset = None, 0
        for batch in batches:
            for ids, m in _by_length(batch):
                for i in range(0, len(ids), VECTORS):
                    part = np.ascontiguousarray(m[i : i + VECTORS], "<i8")
                    row = {
                        "n": m.shape[1],
                        "ids": ids[i : i + VECTORS].tobytes(),
                        "cells": cells(part, *bounds[m.shape[1]]).tobytes(),
                        "path": path,
                        "offset": offset,
                    }
                    if out is None:
                        fs, at = store.opened(path)
                        out = fs.open_output_stream(at)
                    out.write(part.tobytes())
                    offset += part.nbytes
                    yield pa.RecordBatch.from_pylist([row], _FILE)
        if out is not None:
            out.close()

    return store.keep(spark, vectors.mapInArrow(run, "n int, ids binary, cells binary, path string, offset long"), "va-file")


class _Exact:
    """Exact vectors of one block; each is read when it is first asked for."""

    def __init__(self, opened: dict, row: dict, size: int):
        self.opened, self.path, self.offset = opened, row["path"], row["offset"]
        self.have = np.zeros(size, bool)
        self.vectors = np.zeros((size, row["n"]), np.int64)

    def __call__(self, at: np.ndarray) -> np.ndarray:
        missing = np.sort(at[~self.have[at]])
        width = 8 * self.vectors.shape[1]
        if len(missing) and width:
            if self.path not in self.opened:
                fs, name = store.opened(self.path)
                self.opened[self.path] = fs.open_input_file(name)
            for run in np.split(missing, np.flatnonzero(np.diff(missing) > NEAR) + 1):
                a, b = int(run[0]), int(run[-1]) + 1
                self.opened[self.path].seek(self.offset + a * width)
                data = self.opened[self.path].read((b - a) * width)
                self.vectors[a:b] = np.frombuffer(data, "<i8").reshape(b - a, -1)
                self.have[a:b] = True
        return self.vectors[at]


_FILE = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("cells", pa.binary()), ("path", pa.string()), ("offset", pa.int64())])
_ASKED = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("exact", pa.binary()), ("least", pa.binary())])


def _query_blocks(spark: SparkSession, queries: DataFrame) -> list[str]:
    """Files of blocks of `queries(query_id, v, least)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = batch.column(2).to_numpy()
            for n in np.unique(batch.column(1).value_lengths().to_numpy()):
                at = np.flatnonzero(batch.column(1).value_lengths().to_numpy() == n)
                ids = batch.column(0).to_numpy()[at]
                m = batch.column(1).take(pa.array(at)).flatten().to_numpy().reshape(len(at), n)
                for i in range(0, len(at), QUERIES):
                    part = slice(i, i + QUERIES)
                    row = {
                        "n": int(n),
                        "ids": ids[part].tobytes(),
                        "exact": np.ascontiguousarray(m[part]).tobytes(),
                        "least": least[at][part].tobytes(),
                    }
                    yield pa.RecordBatch.from_pylist([row], _ASKED)

    rows = queries.select("query_id", "v", "least").mapInArrow(run, "n int, ids binary, exact binary, least binary")
    return store.keep(spark, rows, "va-queries").inputFiles()


def _asked(files: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for name in files:
        fs, at = store.opened(name)
        with fs.open_input_file(at) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=1, use_threads=False):
                for row in batch.to_pylist():
                    ids = np.frombuffer(row["ids"], np.int64)
                    yield (
                        row["n"],
                        ids,
                        np.frombuffer(row["exact"], np.int64).reshape(len(ids), row["n"]),
                        np.frombuffer(row["least"], np.int64),
                    )


def _bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of queries (rows) with vectors (columns)."""
    more, less = np.maximum(q, 0), np.minimum(q, 0)
    return products(more, low) + products(less, high), products(more, high) + products(less, low)


def _thresholds(files: list[str], bounds, k: int):
    """Per task and query, the k-th largest lower bound, if there are k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [r for b in batches for r in b.to_pylist()]
        for n, ids, q, _ in _asked(files):
            best = np.full((len(ids), k), -_LONG, np.int64)
            for row in blocks:
                if row["n"] != n:
                    continue
                vec = np.frombuffer(row["ids"], np.int64)
                low, high = edges(np.frombuffer(row["cells"], np.uint8).reshape(len(vec), n), *bounds[n])
                lower = _bounds(q, low, high)[0]
                lower[ids[:, None] == vec[None, :]] = -_LONG
                both = np.concatenate([best, lower], axis=1)
                best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            least = best.min(axis=1)
            sure = least > -_LONG
            yield pa.RecordBatch.from_arrays([pa.array(ids[sure]), pa.array(least[sure])], names=["query_id", "least"])

    return run


def _search(files: list[str], bounds, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [r for b in batches for r in b.to_pylist()]
        opened: dict = {}
        for n, ids, q, least in _asked(files):
            # The k best so far, as (score, id), of every query of the block.
            best: list[list[tuple[int, int]]] = [[] for _ in ids]
            bar = least.copy()
            scored = [0] * len(ids)
            for row in blocks:
                if row["n"] != n:
                    continue
                vec = np.frombuffer(row["ids"], np.int64)
                low, high = edges(np.frombuffer(row["cells"], np.uint8).reshape(len(vec), n), *bounds[n])
                exact = _Exact(opened, row, len(vec))
                upper = _bounds(q, low, high)[1]
                open_ = (upper >= bar[:, None]) & (ids[:, None] != vec[None, :])
                for i in np.flatnonzero(open_.any(axis=1)).tolist():
                    found = np.flatnonzero(open_[i])
                    found = found[np.argsort(-upper[i, found], kind="stable")]
                    for a in range(0, len(found), 4 * k):
                        part = found[a : a + 4 * k]
                        part = part[upper[i, part] >= bar[i]]
                        if not len(part):
                            break
                        score = products(q[i : i + 1], exact(part))[0]
                        scored[i] += len(part)
                        best[i] += zip(score.tolist(), vec[part].tolist(), strict=True)
                        best[i].sort(key=lambda x: (-x[0], x[1]))
                        del best[i][k:]
                        if len(best[i]) == k:
                            bar[i] = max(bar[i], best[i][-1][0])
            rows = [
                (int(ids[i]), v, s, scored[i] if at == 0 else 0)
                for i, found in enumerate(best)
                for at, (s, v) in enumerate(found)
            ]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score", "n_scored"]
            )
        for f in opened.values():
            f.close()

    return run


def found_by_task(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """`query_id, vec_id, score, n_scored`: the k best of each task, and, on one row of a query and task, how
    many exact vectors it took to find them."""
    vectors = store.keep(spark, vectors, "vectors")
    bounds = ranges(vectors)
    file = approximation_file(spark, vectors, bounds)
    asked = store.keep(spark, queries.select("query_id", "v"), "queries")
    files = _query_blocks(spark, asked.withColumn("least", F.lit(-_LONG)))
    sure = file.select("n", "ids", "cells").mapInArrow(_thresholds(files, bounds, k), "query_id long, least long")
    sure = sure.groupBy("query_id").agg(F.max("least").alias("least"))
    known = asked.join(sure, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(-_LONG)))
    files = _query_blocks(spark, known)
    return file.mapInArrow(_search(files, bounds, k), "query_id long, vec_id long, score long, n_scored long")


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """`query_id, rank, vec_id, score` for `queries(query_id, v)` over `vectors(vec_id, v)`."""
    found = found_by_task(spark, vectors, queries, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
