"""Approximate search: k-means cells (IVF, Jégou et al. 2011) and random
hyperplane bands (LSH, Charikar 2002)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions import vectors as vx
from docsift.operators.topk import SCORE_DIGITS, rank_hits

ROWS_PER_CELL = 256
NO_CELL = -1
TRAIN_ROWS, TRAIN_ROWS_PER_CELL = 1 << 16, 39
_STEP = 512  # vectors measured against all centres at a time


def cell_count(n: int) -> int:
    """About sqrt(n), and no cells of a few rows."""
    return max(1, min(round(math.sqrt(n)), n // ROWS_PER_CELL))


def training_rows(vectors: DataFrame, key: str, n: int, n_cells: int) -> DataFrame:
    """The rows that centres are fitted to: all `n`, or those of the smallest hashes of their keys, about
    `TRAIN_ROWS` or `TRAIN_ROWS_PER_CELL` a cell if that is more. With sqrt(n) cells k-means over all rows
    takes n^1.5 steps; every row gets its cell whether it was among these or not."""
    most = max(TRAIN_ROWS, TRAIN_ROWS_PER_CELL * n_cells)
    if n <= most:
        return vectors
    parts = 1 << 30
    return vectors.filter(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)) < math.ceil(parts * most / n))


def train_cells(vectors: DataFrame, column: str, n_cells: int, metric: str = "cosine", seed: int = 7) -> np.ndarray:
    """Centres of all vectors; for cosine, of the unit vectors."""
    point = vx.normalise(F.col(column)) if metric == "cosine" else F.col(column)
    unit = vectors.select(point.cast("array<double>").alias("u")).filter(F.col("u").isNotNull())
    points = unit.select(array_to_vector("u").alias("features")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=n_cells, seed=seed, maxIter=8, initSteps=1).fit(points)
    finally:
        points.unpersist()
    return np.stack([np.asarray(c) for c in model.clusterCenters()])


def nearest_cells(vector: Column, centres: np.ndarray, n: int, metric: str = "cosine") -> Column:
    """The `n` closest cells of each vector, closest first. Empty for a null vector and,
    as cosine never returns it, for a zero one under that metric."""
    weights = (centres**2).sum(axis=1)
    n = min(n, len(centres))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def closest(batch: pa.Array) -> pa.Array:
        known = pc.is_valid(batch).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(batch).to_numpy(zero_copy_only=False).astype(np.float64)
        points = flat.reshape(int(known.sum()), centres.shape[1])
        placed = np.ones(len(points), bool)
        if metric == "cosine":
            lengths = np.linalg.norm(points, axis=1)
            placed = lengths > 0
            points = points / np.where(placed, lengths, 1.0)[:, None]
        found = []
        for start in range(0, len(points), _STEP):
            far = weights[None, :] - 2 * points[start : start + _STEP] @ centres.T
            if n == 1:
                best = far.argmin(axis=1)[:, None]
            else:
                best = np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(np.arange(n), (len(far), 1))
                order = np.lexsort((best, np.take_along_axis(far, best, axis=1)), axis=1)
                best = np.take_along_axis(best, order, axis=1)
            found.append(best.astype(np.int32))
        closest_cells = np.concatenate(found) if found else np.zeros((0, n), np.int32)
        counts = np.zeros(len(batch), np.int64)
        counts[known] = np.where(placed, n, 0)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(closest_cells[placed].ravel()))

    return closest(vector)


def cell_of(vector: Column, centres: np.ndarray, metric: str = "cosine") -> Column:
    return F.coalesce(F.get(nearest_cells(vector, centres, 1, metric), F.lit(0)), F.lit(NO_CELL))


def hyperplanes(dim: int, bands: int, bits: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, bands * bits))


def band_keys(vector: Column, dim: int, bands: int, bits: int, seed: int = 11) -> Column:
    """`bands` keys of `bits` hyperplane signs each; the band number is part of the key."""
    planes = hyperplanes(dim, bands, bits, seed)
    place = (1 << np.arange(bits)).astype(np.int64)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(batch: pa.Array) -> pa.Array:
        known = pc.is_valid(batch).to_numpy(zero_copy_only=False)
        points = pc.list_flatten(batch).to_numpy(zero_copy_only=False).astype(np.float64).reshape(int(known.sum()), dim)
        signs = (points @ planes > 0).reshape(len(points), bands, bits)
        codes = (signs * place).sum(axis=2) + (np.arange(bands, dtype=np.int64) << bits)[None, :]
        offsets = np.concatenate([[0], np.cumsum(np.where(known, bands, 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel()))

    return keys(vector)


def write_bands(vectors: DataFrame, table: str, dim: int, bands: int, bits: int, buckets: int = 8) -> None:
    """Store one row (band, key) for each band of each vector, bucketed by band: a search
    then meets only the rows of its own bands."""
    rows = vectors.select("key", F.explode(band_keys(F.col("vector"), dim, bands, bits)).alias("band"))
    rows.write.mode("overwrite").bucketBy(buckets, "band").sortBy("band").saveAsTable(table)


def banded_search(
    stored: DataFrame, vectors: DataFrame, queries: DataFrame, k: int, dim: int, bands: int, bits: int
) -> DataFrame:
    """Best k by cosine among the vectors that share a stored band with the query."""
    asked = queries.select("query_id", F.explode(band_keys(F.col("vector"), dim, bands, bits)).alias("band"))
    pairs = stored.join(asked, "band").select("query_id", "key").distinct()
    met = pairs.join(vectors.select("key", "vector"), "key")
    met = met.join(queries.select("query_id", F.col("vector").alias("asked")), "query_id")
    scored = met.select("query_id", "key", F.round(vx.cosine(F.col("asked"), F.col("vector")), SCORE_DIGITS).alias("score"))
    return rank_hits(scored.filter(F.col("score").isNotNull()), k)
