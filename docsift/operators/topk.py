"""Top-k of many queries against a table, in one scan and without row pairs.

A batch of queries is small and of checked size, so it travels to the tasks.
Each task scores its Arrow batches against the whole batch with matrix
arithmetic, keeps the k best per query while it reads, and emits only those.
The shuffle therefore carries at most `queries x k` rows per task, whatever the
size or skew of the scanned table.

Query sets beyond that size are spread instead: queries and vectors are dealt to the
cells that the queries visit (one cell, if there are none), heavy cells into slices and
their queries into chunks by measured counts, and a task streams the queries of a block past its slice.
Every query meets every vector it would meet in a scan, so the answer is the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.session import counted, fresh_path, small_side

BATCH_QUERIES = 4096
SCORE_DIGITS = 6
LOWER_IS_BETTER = {"cosine": False, "l2": True, "l1": True}
_SLACK = 2 * 10.0**-SCORE_DIGITS
_DENSE_CELLS = 4_000_000
SLICE_VALUES = 1 << 20  # numbers in a slice of vectors
CHUNK_QUERIES = 8192


class _KBest:
    """The k best (rounded score, then key) per query seen by one task."""

    def __init__(self, n_queries: int, k: int, lower_is_better: bool):
        self.k = k
        self.scored = np.zeros(n_queries, np.int64)
        self.flip = 1.0 if lower_is_better else -1.0
        self.kth = np.full(n_queries, np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n_queries

    def offer(self, queries: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """`scores` is (len(queries), len(keys)); NaN marks a pair to leave out."""
        if scores.size == 0:
            return
        self.scored[queries] += (~np.isnan(scores)).sum(axis=1)
        cost = np.where(np.isnan(scores), np.inf, self.flip * scores)
        hopeful = cost.min(axis=1) <= self.kth[queries] + _SLACK
        for row in np.flatnonzero(hopeful):
            q = int(queries[row])
            line = cost[row]
            limit = self.kth[q]
            if len(line) > self.k:
                limit = min(limit, np.partition(line, self.k - 1)[self.k - 1])
            at = np.flatnonzero((line <= limit + _SLACK) & np.isfinite(line))
            self._merge(q, np.round(line[at], SCORE_DIGITS), keys[at])

    def _merge(self, q: int, cost: np.ndarray, keys: np.ndarray) -> None:
        if self.held[q] is not None:
            cost = np.concatenate([self.held[q][0], cost])
            keys = np.concatenate([self.held[q][1], keys])
        order = np.lexsort((keys, cost))[: self.k]
        self.held[q] = (cost[order], keys[order])
        if len(order) == self.k:
            self.kth[q] = cost[order[-1]]

    def rows(self, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        kept = [(q, h) for q, h in enumerate(self.held) if h is not None and len(h[0])]
        if not kept:
            return
        numbers = np.concatenate([np.full(len(h[0]), q, np.int32) for q, h in kept])
        scores = np.concatenate([self.flip * h[0] for _, h in kept]) + 0.0
        keys = pa.array(np.concatenate([h[1] for _, h in kept]).tolist(), type=key_type)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), keys, pa.array(scores)], names=["query_no", "key", "score"]
        )

    def counts(self, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Per query how many rows were scored, in the `score` column."""
        n = len(self.scored)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n, dtype=np.int32)), pa.nulls(n, key_type), pa.array(self.scored.astype(float))],
            names=["query_no", "key", "score"],
        )


def _require_key(kind: T.DataType) -> None:
    """Keys are whole numbers or strings: others have no order that both sides share."""
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        raise ValueError(f"a key must be a whole number or a string, not {kind.simpleString()}")


def _sortable(keys: pa.Array) -> np.ndarray:
    if pa.types.is_integer(keys.type):
        return keys.to_numpy(zero_copy_only=False)
    return np.array(keys.to_pylist(), dtype=str)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors without nulls as rows; another length than `dim` is an error."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != dim).any():
        raise ValueError(f"a vector of {int(sizes[sizes != dim][0])} numbers among vectors of {dim}")
    flat = pc.list_flatten(vectors)
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """L2 distances by expanded squares; pairs so close that the expansion loses their
    difference are computed from it."""
    squares = (queries**2).sum(axis=1)[:, None] + (vectors**2).sum(axis=1)[None, :]
    found = np.sqrt(np.maximum(squares - 2 * (queries @ vectors.T), 0.0))
    error = 4 * np.finfo(float).eps * (queries.shape[1] + 4) * squares
    for q, v in zip(*np.nonzero(found * 1e-8 < error), strict=True):
        found[q, v] = np.sqrt(((queries[q] - vectors[v]) ** 2).sum())
    return found


def _scores(metric: str, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    if metric == "cosine":
        with np.errstate(divide="ignore", invalid="ignore"):
            lengths = np.outer(np.linalg.norm(queries, axis=1), np.linalg.norm(vectors, axis=1))
            return np.where(lengths > 0, (queries @ vectors.T) / lengths, np.nan)
    if metric == "l2":
        return _distances(queries, vectors)
    if metric == "l1":
        return np.stack([np.abs(vectors - q).sum(axis=1) for q in queries])
    raise ValueError(f"unknown metric {metric!r}")


def rank_hits(scored: DataFrame, k: int, lower_is_better: bool = False) -> DataFrame:
    """`rank` 1..k per query by score, ties by key."""
    by = F.col("score").asc() if lower_is_better else F.col("score").desc()
    order = Window.partitionBy("query_id").orderBy(by, F.col("key").asc())
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def in_batches(
    queries: DataFrame, run: Callable[[pa.Table], DataFrame], limit: int = BATCH_QUERIES
) -> DataFrame:
    """Apply `run` to `queries` (with a `query_id`) in batches of checked size.

    Ids must tell queries apart. A block that comes out too large is split again.
    """
    spark = queries.sparkSession
    n, n_ids = queries.agg(F.count("*"), F.count_distinct("query_id")).first()
    if n != n_ids:
        raise ValueError("query_id must tell queries apart: it is null or repeated")
    if n <= limit:
        return run(queries.toArrow())
    path = fresh_path(spark, "hits")

    def work(part: DataFrame, size: int, depth: int) -> None:
        if size <= limit:
            run(part.toArrow()).write.mode("append").parquet(path)
            return
        blocks = math.ceil(1.25 * size / limit)
        block = F.pmod(F.xxhash64("query_id", F.lit(depth)), F.lit(blocks))
        sizes = part.groupBy(block.alias("block")).agg(F.count("*").alias("n")).collect()  # one row a block
        for row in sizes:
            work(part.filter(block == row["block"]), row["n"], depth + 1)

    work(queries, n, 0)
    return spark.read.parquet(path)


def _named(df: DataFrame, batch: pa.Table, id_type: T.DataType) -> DataFrame:
    """Swap the batch-local query number for the caller's id."""
    numbers = pa.array(np.arange(batch.num_rows, dtype=np.int32))
    ids = df.sparkSession.createDataFrame(
        pa.table({"query_no": numbers, "query_id": batch.column("query_id").combine_chunks()})
    )
    ids = ids.withColumn("query_id", F.col("query_id").cast(id_type))
    return df.join(F.broadcast(ids), "query_no").drop("query_no")


def _emit_schema(key_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_no", T.IntegerType()),
            T.StructField("key", key_type),
            T.StructField("score", T.DoubleType()),
        ]
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    batch_queries: int = BATCH_QUERIES,
    within: str | None = None,
    count_only: bool = False,
) -> DataFrame:
    """Best k rows of `vectors(key, vector)` per `queries(query_id, vector)`.

    `within` narrows the search. "cells": a row is scored only for the queries whose
    `probes` list its `cell`, and the scan reads only probed cells. "bands": only for
    the queries that share one of its `bands` keys. `count_only` returns
    `query_id, n_scored` in place of hits. Null vectors are no hits, and queries
    without a vector have none; vectors of another length than the queries are an error.
    """
    if metric not in LOWER_IS_BETTER:
        raise ValueError(f"unknown metric {metric!r}")
    id_type = queries.schema["query_id"].dataType
    key_type = vectors.schema["key"].dataType
    _require_key(key_type)
    lower = LOWER_IS_BETTER[metric]
    queries = queries.filter(F.col("vector").isNotNull())
    if within != "bands" and not count_only and queries.limit(batch_queries + 1).count() > batch_queries:
        return spread(vectors, queries, k, metric, within)
    query_side = {None: [], "cells": ["probes"], "bands": ["bands"]}[within]
    vector_side = {None: [], "cells": ["cell"], "bands": ["bands"]}[within]

    def run(batch: pa.Table) -> DataFrame:
        rows = batch.column("vector").combine_chunks()
        dim = len(rows[0].as_py()) if len(rows) else 1
        targets = _matrix(rows, dim)
        askers: dict[int, np.ndarray] = {}
        if within:
            lists: dict[int, list[int]] = {}
            for number, wanted in enumerate(batch.column(query_side[0]).to_pylist()):
                for value in wanted:
                    lists.setdefault(value, []).append(number)
            askers = {value: np.array(numbers) for value, numbers in lists.items()}
        source = vectors
        if within == "cells":
            source = vectors.filter(F.col("cell").isin(sorted(askers)))
        shipped = vectors.sparkSession.sparkContext.broadcast((targets, askers))

        def score_batch(piece: pa.RecordBatch, best: _KBest, targets: np.ndarray, askers: dict) -> None:
            keys = _sortable(piece.column(0))
            matrix = _matrix(piece.column(1), targets.shape[1])
            if within is None:
                best.offer(np.arange(len(targets)), _scores(metric, targets, matrix), keys)
            elif within == "cells":
                owner = piece.column(2).to_numpy(zero_copy_only=False)
                for cell in np.unique(owner):
                    at = np.flatnonzero(owner == cell)
                    asking = askers.get(int(cell))
                    if asking is not None:
                        best.offer(asking, _scores(metric, targets[asking], matrix[at]), keys[at])
            else:
                meets = np.zeros((len(targets), len(keys)), bool)
                owner = np.repeat(
                    np.arange(len(keys)), pc.list_value_length(piece.column(2)).to_numpy(zero_copy_only=False)
                )
                band = pc.list_flatten(piece.column(2)).to_numpy(zero_copy_only=False)
                order = np.argsort(band, kind="stable")
                names, starts = np.unique(band[order], return_index=True)
                for name, members in zip(names, np.split(owner[order], starts[1:])):
                    asking = askers.get(int(name))
                    if asking is not None:
                        meets[np.ix_(asking, members)] = True
                for number in np.flatnonzero(meets.any(axis=1)):
                    at = np.flatnonzero(meets[number])
                    one = np.array([number])
                    best.offer(one, _scores(metric, targets[one], matrix[at]), keys[at])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            targets, askers = shipped.value
            if len(targets) == 0:
                return
            best = _KBest(len(targets), k, lower)
            step = max(1, _DENSE_CELLS // len(targets))
            arrow_key = None
            for whole in batches:
                arrow_key = whole.column(0).type
                # Dropped here: a filter below would have vectors that a model computes computed twice.
                whole = whole.filter(whole.column(1).is_valid())
                for start in range(0, whole.num_rows, step):
                    score_batch(whole.slice(start, step), best, targets, askers)
            if arrow_key is not None:
                yield from best.counts(arrow_key) if count_only else best.rows(arrow_key)

        local = source.select("key", "vector", *vector_side).mapInArrow(scan, _emit_schema(key_type))
        named = _named(local, batch, id_type)
        if count_only:
            return named.groupBy("query_id").agg(F.sum("score").cast("bigint").alias("n_scored"))
        return rank_hits(named, k, lower)

    return in_batches(queries.select("query_id", "vector", *query_side), run, batch_queries)


def _spread_scan(k: int, metric: str):
    lower = LOWER_IS_BETTER[metric]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows `cell, slice, chunk, search, key, query_id, vector`, sorted: for every block its vectors, then its queries."""
        block, keys, parts, matrix = None, [], [], None
        for batch in batches:
            batch = batch.filter(batch.column(6).is_valid())
            marks = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            ends = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                piece, mark = batch.slice(a, b - a), marks[a].tolist()
                if mark[:3] != block:
                    block, keys, parts, matrix = mark[:3], [], [], None
                if not mark[3]:
                    keys.append(_sortable(piece.column(4)))
                    parts.append(piece.column(6))
                    continue
                if not parts:
                    continue
                if matrix is None:
                    first = pc.list_value_length(parts[0])[0].as_py()
                    matrix, held = np.concatenate([_matrix(p, first) for p in parts]), np.concatenate(keys)
                step = max(1, _DENSE_CELLS // len(matrix))
                for at in range(0, piece.num_rows, step):
                    some = piece.slice(at, step)
                    targets = _matrix(some.column(6), matrix.shape[1])
                    best = _KBest(len(targets), k, lower)
                    best.offer(np.arange(len(targets)), _scores(metric, targets, matrix), held)
                    for rows in best.rows(piece.column(4).type):
                        ids = some.column(5).take(rows.column(0))
                        yield pa.RecordBatch.from_arrays([ids, rows.column(1), rows.column(2)], names=["query_id", "key", "score"])

    return scan


def spread(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", within: str | None = None) -> DataFrame:
    """What `nearest` returns, for query sets that are too large to be sent to every task: one job, whatever their number.

    The counts of the cells say into how many slices and chunks a block is dealt; only the k best of every query
    and slice go on.
    """
    spark = vectors.sparkSession
    key_type, id_type = vectors.schema["key"].dataType, queries.schema["query_id"].dataType
    n, n_ids = queries.agg(F.count("*"), F.count_distinct("query_id")).first()
    if n != n_ids:
        raise ValueError("query_id must tell queries apart: it is null or repeated")
    cell = F.col("cell") if within == "cells" else F.lit(0)
    probes = F.explode("probes") if within == "cells" else F.lit(0)
    points = vectors.select(cell.cast("int").alias("cell"), "key", "vector")
    asked = queries.select(probes.alias("cell"), "query_id", "vector").withColumn("cell", F.col("cell").cast("int"))
    # Rows are counted, not vectors: a model that computes them need not run for that.
    first = queries.select(F.size("vector")).first()
    values = F.count("*") * (first[0] if first else 1)
    sizes = points.groupBy("cell").agg(F.greatest(F.ceil(values / SLICE_VALUES), F.lit(1)).alias("slices"))
    asks = asked.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK_QUERIES).alias("chunks"))
    # One row a cell.
    grid, n_cells = counted(spark, sizes.join(asks, "cell"), "spread")

    def dealt(rows: DataFrame, by: str, own: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1))
        placed = rows.join(small_side(grid, n_cells), "cell").withColumn(own, F.pmod(F.xxhash64(by), F.col(f"{own}s")))
        return placed.withColumn(other, every)

    points = dealt(points, "key", "slice", "chunk").withColumns({"search": F.lit(False), "query_id": F.lit(None).cast(id_type)})
    asked = dealt(asked, "query_id", "chunk", "slice").withColumns({"search": F.lit(True), "key": F.lit(None).cast(key_type)})
    columns = ["cell", "slice", "chunk", "search", "key", "query_id", "vector"]
    kind = vectors.schema["vector"].dataType
    both = points.select(*columns).unionByName(asked.withColumn("vector", F.col("vector").cast(kind)).select(*columns))
    dealt_out = both.repartition(*columns[:3]).sortWithinPartitions(*columns[:4])
    schema = T.StructType(
        [T.StructField("query_id", id_type), T.StructField("key", key_type), T.StructField("score", T.DoubleType())]
    )
    return rank_hits(dealt_out.mapInArrow(_spread_scan(k, metric), schema), k, LOWER_IS_BETTER[metric])


K1, B = 1.2, 0.75


def bm25(
    postings: DataFrame,
    queries: DataFrame,
    k: int,
    avg_len: float,
    batch_queries: int = BATCH_QUERIES,
) -> DataFrame:
    """Best k keys per query by BM25 (Robertson & Zaragoza 2009; k1 = 1.2, b = 0.75).

    `postings(key, term, tf, doc_len)`; `queries(query_id, terms array<struct<term, idf>>)`
    with distinct terms. Postings of other terms are dropped at the scan, the rest
    meet by key - no shuffle when the table is bucketed by key - and each document
    is scored against all queries where it lies.
    """
    id_type = queries.schema["query_id"].dataType
    key_type = postings.schema["key"].dataType
    _require_key(key_type)

    def run(batch: pa.Table) -> DataFrame:
        spark = postings.sparkSession
        per_query = batch.column("terms").to_pylist()
        idf: dict[str, float] = {}
        asked_by: dict[str, list[int]] = {}
        for number, entries in enumerate(per_query):
            for entry in entries or []:
                idf[entry["term"]] = entry["idf"]
                asked_by.setdefault(entry["term"], []).append(number)
        vocabulary = sorted(idf)
        askers = [np.array(asked_by[t]) for t in vocabulary]
        starts = np.concatenate([[0], np.cumsum([len(a) for a in askers])]).astype(np.int64)
        flat_askers = np.concatenate(askers) if askers else np.zeros(0, np.int64)
        shipped = spark.sparkContext.broadcast(
            (vocabulary, np.array([idf[t] for t in vocabulary]), starts, flat_askers, len(per_query))
        )

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, weights, first, queries_of, n_queries = shipped.value
            if not words:
                return
            value_set = pa.array(words)
            fan_out = np.diff(first)
            best = _KBest(n_queries, k, lower_is_better=False)
            everyone = np.arange(n_queries)
            step = max(1, _DENSE_CELLS // n_queries)
            arrow_key = None
            for whole in batches:
                arrow_key = whole.column(0).type
                for start in range(0, whole.num_rows, step):
                    piece = whole.slice(start, step)
                    n = piece.num_rows
                    lengths = pc.list_value_length(piece.column(2)).to_numpy(zero_copy_only=False)
                    found = pc.list_flatten(piece.column(2))
                    code = pc.index_in(found.field("term"), value_set=value_set).to_numpy(zero_copy_only=False)
                    tf = found.field("tf").to_numpy(zero_copy_only=False).astype(np.float64)
                    row = np.repeat(np.arange(n), lengths)
                    size = piece.column(1).to_numpy(zero_copy_only=False).astype(np.float64)[row]
                    gain = weights[code] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / avg_len))
                    times = fan_out[code]
                    inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    asker = queries_of[np.repeat(first[code], times) + inside]
                    cell = asker * n + np.repeat(row, times)
                    score = np.bincount(cell, weights=np.repeat(gain, times), minlength=n_queries * n)
                    score = np.where(score > 0, score, np.nan).reshape(n_queries, n)
                    best.offer(everyone, score, _sortable(piece.column(0)))
            if arrow_key is not None:
                yield from best.rows(arrow_key)

        word_rows = spark.createDataFrame(pa.table({"term": pa.array(vocabulary, pa.string())}))
        kept = postings.join(F.broadcast(word_rows), "term", "left_semi")
        if 0 < len(vocabulary) <= 500:
            kept = kept.filter(F.col("term").isin(vocabulary))
        local = (
            kept.groupBy("key")
            .agg(F.first("doc_len").alias("doc_len"), F.collect_list(F.struct("term", "tf")).alias("found"))
            .select("key", "doc_len", "found")
            .mapInArrow(scan, _emit_schema(key_type))
        )
        return rank_hits(_named(local, batch, id_type), k)

    return in_batches(queries.select("query_id", "terms"), run, batch_queries)
