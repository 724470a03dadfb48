import hashlib
import random
import re

import pytest

from docsift.llm import mixture, store

SCHEMA = "doc_id long, text string, source string, u double, size string, `row` int, `of.x` int, target string, n int"


def brute(rows, weights=(3, 1, 2), share=1.5, most=2.0, given=None):
    """`(doc_id, size, source_size, target, copies)` by rounds of sharing."""
    size = [len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    whole = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    weight = {s: given.get(s, 0) if given else weights[i % len(weights)] for i, s in enumerate(names)}
    full, target = set(), {}
    while True:
        rest = share * sum(whole.values()) - sum(most * whole[s] for s in full)
        among = sum(weight[s] for s in names if s not in full)
        target = {s: most * whole[s] if s in full else weight[s] * rest / among for s in names} if among else {
            s: most * whole[s] if weight[s] or s in full else 0 for s in names}
        above = {s for s in names if s not in full and target[s] > most * whole[s]}
        if not above:
            break
        full |= above
    out = []
    for (i, t, s), n in zip(rows, size, strict=True):
        rate = target[s] / whole[s] if whole[s] else 0
        key = f"20:{'' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / (1 << 52)
        out.append((i, n, whole[s], target[s], int(rate) + (u < rate - int(rate))))
    return out


def made(spark, rows):
    store.settle(spark)
    return spark.createDataFrame([(*r, 0.1, "x", 1, 2, "y", 3) for r in rows], SCHEMA)


def near(got, want):
    key = lambda r: (str(r[0]), r[1:3], r[4])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [(*r[:3], r[4]) for r in got] == [(*r[:3], r[4]) for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


def plan(spark, rows, **more):
    return mixture.planned(spark, mixture.measured(made(spark, rows)), **more).select(
        "doc_id", "size", "source_size", "target", "copies"
    )


def some(n, sources, seed):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 400])), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("share, most", [(1.5, 2.0), (0.3, 2.0), (1.9, 2.0), (1.0, 1.0), (3.0, 2.0)])
def test_against_plain_sharing(spark, share, most):
    rows = some(400, ["a"] * 9 + ["b", "c", "\U0001f600", "é", "￿", None, "", "Z"], 1)
    near(plan(spark, rows, share=share, most=most).collect(), brute(rows, share=share, most=most))


def test_given_weights(spark):
    rows = some(300, ["a", "b", "c", None], 2)
    weights = spark.createDataFrame([("a", 5.0), (None, 1.0), ("zz", 9.0)], "source string, weight double")
    near(plan(spark, rows, weights=weights).collect(), brute(rows, given={"a": 5.0, None: 1.0}))


def test_many_sources_are_salted_and_ranked_over_partitions(spark, monkeypatch):
    rows = some(500, [f"s{i}" for i in range(150)] + ["hot"] * 80, 3)
    want = brute(rows)
    near(plan(spark, rows).collect(), want)
    whole = mixture.joined
    monkeypatch.setattr(mixture, "joined", lambda r, s: whole(r, s, limit=10))
    near(plan(spark, rows).collect(), want)


def test_edges(spark):
    rows = [(1, None, "a"), (1, "", "a"), (2, " \t\n", None), (3, "x y", "b"), (3, "x y", "b"), (3, "x z", "b"), (None, "q", "b"),
            (None, None, None), (4, "é ü 😀\x0bb", "c"), (5, "w " * 200_000, "d")]
    near(plan(spark, rows).collect(), brute(rows))
    near(plan(spark, [(1, None, "a"), (2, " ", None)]).collect(), [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])
    assert plan(spark, []).collect() == []
    assert mixture.emitted(spark, made(spark, [])).collect() == []


def test_the_mix_holds_the_copies_and_its_words_are_near_the_targets(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randrange(20, 60)), rng.choice(["hot"] * 5 + ["a", "b", "c", "d"])) for i in range(6000)]
    docs = made(spark, rows)
    mix = mixture.emitted(spark, docs)
    assert mix.schema == docs.schema
    got = {}
    for r in mix.select("doc_id", "source").collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    want = brute(rows)
    assert got == {i: c for i, _, _, _, c in want if c}
    sums, target = {}, {}
    for (_, _, s), (_, n, _, t, c) in zip(rows, want, strict=True):
        sums[s], target[s] = sums.get(s, 0) + n * c, t
    assert all(abs(sums[s] - target[s]) < 0.05 * target[s] for s in sums)
    assert sorted(map(str, mixture.emitted(spark, docs.repartition(7)).collect())) == sorted(map(str, mix.collect()))
