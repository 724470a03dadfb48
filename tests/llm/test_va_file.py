import math
import random

import numpy as np
import pytest

from docsift.llm import store, va_file


def brute(rows, k, every):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def searched(spark, rows, k, every):
    store.settle(spark)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score int")
    vectors = va_file.whole_vectors(table, "vec_id", "embedding")
    queries = vectors.where(f"vec_id % {every} = 0").withColumnRenamed("vec_id", "query_id")
    return sorted(map(tuple, va_file.top_k(spark, vectors, queries, k).collect()))


def wide(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], 1, 2) for i, v in rows]


@pytest.mark.parametrize("scale", [1.0, 1e-4, 1e3, 1e5])
def test_against_all_pairs(spark, scale, monkeypatch):
    monkeypatch.setattr(va_file, "VECTORS", 37)
    monkeypatch.setattr(va_file, "QUERIES", 5)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(8)]) for i in range(400)]
    rows[7] = (7, rows[3][1])
    rows[9] = (9, rows[3][1])  # ties go to the smaller id
    rows = [(i, v) for i, v, *_ in wide(rows)]
    assert searched(spark, wide(rows), 10, 20) == brute(rows, 10, 20)


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]),
            (6, [-1.0, 2.0]), (7, [1.0, 2.0, 3.0]), (10, [1.0, 1.0, 1.0]), (None, [9.0, 9.0]), (20, [0.0, 0.0]),
            (30, [3.0]), (40, [])]
    got = searched(spark, wide(rows), 3, 10)
    assert got == brute(rows, 3, 10)
    assert [r[2] for r in got if r[0] == 10] == [7]
    assert searched(spark, [], 3, 10) == []


def test_rows_that_share_an_id(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [3.0]), (0, [4.0])]
    got = searched(spark, wide(rows), 5, 10)
    assert [r[2] for r in got] and {r[2] for r in got} == {1}


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(2)
    m = rng.integers(-3000, 3000, (200, 6))
    low, high = m.min(axis=0), m.max(axis=0)
    cell = va_file.cells(m, low, high)
    a, b = va_file.edges(cell, low, high)
    assert (a <= m).all() and (m <= b).all()
    q = rng.integers(-3000, 3000, (20, 6))
    lower, upper = va_file._bounds(q, a, b)
    exact = q @ m.T
    assert (lower <= exact).all() and (exact <= upper).all()
    big = np.array([[1 << 40, 3], [-(1 << 40), 5]])
    assert va_file.products(big, big)[0].tolist() == [(1 << 63) - 1, -((1 << 63) - 1)]
    assert va_file.products(np.array([[1 << 30, 7]]), np.array([[1 << 30, 3]]))[0, 0] == (1 << 60) + 21


def test_only_some_exact_vectors_are_read(spark):
    rng = random.Random(8)
    rows = wide([(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(3000)])
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score int").coalesce(2)
    vectors = va_file.whole_vectors(table, "vec_id", "embedding")
    queries = vectors.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    found = va_file.found_by_task(spark, vectors, queries, 10).collect()
    assert 300 <= sum(r["n_scored"] for r in found) < 0.05 * 30 * 3000
    file = va_file.approximation_file(spark, vectors, va_file.ranges(vectors))
    assert file.columns == ["n", "ids", "cells", "path", "offset"]
    row = file.first()
    exact = va_file._Exact({}, row, len(row["ids"]) // 8)
    wanted = np.array([7, 3, 900])
    by_id = {r["vec_id"]: r["v"] for r in vectors.collect()}
    ids = np.frombuffer(row["ids"], np.int64)
    assert exact(wanted).tolist() == [by_id[i] for i in ids[wanted].tolist()]
    assert exact.have.sum() <= 2 + va_file.NEAR + 1
