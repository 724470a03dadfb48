import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import store
from docsift.llm import vector_codes as vc

LONG = (1 << 63) - 1
SCHEMA = "vec_id long, embedding array<float>, label int, code string, of int, salt string, `a.b` int"


def brute(rows, scale=256, parts=16, entries=64, rounds=2):
    """`{(vec_id, label): (code, error)}` rows by a plain loop over all entries."""
    kept = [(i, y, [math.floor(scale * x) for x in v]) for i, v, y in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], None
    length = len(kept[0][2])
    cuts = [i * length // parts for i in range(parts + 1)]
    same = [r for r in kept if len(r[2]) == length]
    books = [[r[2][cuts[p] : cuts[p + 1]] for r in same[:entries]] for p in range(parts)]

    def assigned(v):
        out = []
        for p, book in enumerate(books):
            x = v[cuts[p] : cuts[p + 1]]
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book)))
        return out

    for _ in range(rounds):
        found = [[k for _, k in assigned(r[2])] for r in same]
        for p, book in enumerate(books):
            for k in range(len(book)):
                own = [r[2][cuts[p] : cuts[p + 1]] for r, f in zip(same, found, strict=True) if f[p] == k]
                if own:
                    book[k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for i, y, v in kept:
        near = assigned(v) if len(v) == length else None
        code = None if near is None else "".join(f"{k:02x}" for _, k in near)
        out.append((i, y, code, None if near is None else min(sum(d for d, _ in near), LONG)))
    sums = {}
    for _, y, _, e in out:
        sums[y] = min(sums.get(y, 0) + (e or 0), LONG)
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted([(i, c, e, sums[y]) for i, y, c, e in out], key=repr), hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows):
    store.settle(spark)
    return spark.createDataFrame([(i, v, y, "x", 1, "y", 2) for i, v, y in rows], SCHEMA)


def compressed(spark, rows, **more):
    out = vc.compress(spark, table(spark, rows), **more).collect()
    got = sorted([(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in out], key=repr)
    return got, {r["codebooks_sha256"] for r in out}


def narrow(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]


@pytest.mark.parametrize("length, scale", [(64, 0.13), (32, 1.0), (40, 3.0), (16, 2e4), (7, 1.0), (64, 1e12), (200, 1.0)])
def test_against_all_entries(spark, length, scale):
    rng = random.Random(length)
    rows = narrow([(i, [rng.gauss(0, scale) for _ in range(length)], rng.choice([1, 2, None])) for i in range(180)])
    want, digest = brute(rows)
    assert compressed(spark, rows) == (want, {digest})


def test_ties_and_full_memo(spark, monkeypatch):
    """Few different values, so that entries are equal and points lie between entries; few boxes are remembered."""
    monkeypatch.setattr(vc, "MEMO", 3)
    monkeypatch.setattr(vc, "PAIRS", 50)
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 1 / 256, 2 / 256, 1.0]) for _ in range(32)], i % 3) for i in range(300)]
    want, digest = brute(rows)
    assert compressed(spark, rows) == (want, {digest})


def test_hashes_that_collide(spark, monkeypatch):
    monkeypatch.setattr(vc, "_bits", lambda x: np.zeros(len(x), np.uint64))
    rng = random.Random(2)
    book = np.array([[rng.randrange(-90, 90) for _ in range(4)] for _ in range(64)])
    points = np.array([[rng.randrange(-400, 400) for _ in range(4)] for _ in range(500)])
    near = vc.Nearest(book)
    index, distance = near(points)
    all_ = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (index == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()


def test_boxes_leave_most_entries_out():
    rng = np.random.default_rng(3)
    book = rng.integers(-100, 100, (64, 4))
    points = rng.integers(-100, 100, (50_000, 4))
    near = vc.Nearest(book)
    index, _ = near(points)
    assert (index == ((points[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert near.evaluated < 0.15 * points.shape[0] * 64 and near.boxes < 2 * vc.BOXES
    before = near.boxes
    assert before < vc.MEMO
    near(points)
    assert near.boxes == before  # all remembered


def test_edges(spark):
    rows = [(3, [1.0] * 16, 1), (None, [2.0] * 16, 1), (5, None, 1), (6, [None] * 16, 1), (7, [math.nan] * 16, 2),
            (8, [math.inf] * 16, 2), (9, [0.5] * 15, 2), (9, [], None), (4, [1.0] * 16, None), (4, [1.0] * 16, None),
            (4, [0.0] * 16, None)]
    want, digest = brute(rows)
    assert compressed(spark, rows) == (want, {digest})
    assert [r[1:3] for r in want if r[0] == 9] == [(None, None)] * 2
    assert compressed(spark, []) == ([], set())
    assert compressed(spark, [(1, [], 1)])[0] == [(1, "00" * 16, 0, 0)]
    big = narrow([(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [1.0] * 16, 1)])
    assert len(compressed(spark, big, rounds=0)[0]) == 3


def test_many_labels_are_salted(spark):
    rows = [(i, f"{i:02x}", i, None if i % 3 == 0 else i % 7) for i in range(200)]
    codes = spark.createDataFrame(rows, "vec_id long, code string, error long, label int")
    few = vc.with_label_error(spark, codes)
    many = vc.with_label_error(spark, codes, limit=2)
    assert sorted(map(tuple, few.select(*many.columns).collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)


def test_decoding(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)], 0) for i in range(100)]
    vectors = vc.whole_vectors(table(spark, rows), "vec_id", "embedding", "label")
    length, books = vc.train(vectors)
    codes = vc.coded(vectors, length, books)
    both = vc.decoded(codes, books, length).withColumnRenamed("v", "of").join(vectors, "vec_id").join(codes, "vec_id")
    far = F.aggregate(F.zip_with("of", "v", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, x: s + x)
    assert both.where(far != F.col("error")).count() == 0 and both.count() == 100
