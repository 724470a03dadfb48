import random

import numpy as np
import pytest

from docsift.llm import near_duplicates, setsketch, store
from docsift.llm.components import components
from docsift.llm.shingles import shingle_sets


def shingles(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def brute(rows, size, percent):
    """Component of every row with an id, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for g, (doc_id, _) in zip(group, rows, strict=True):
        first[g] = min(doc_id, first.get(g, doc_id))
    return [(doc_id, len(s), first[g], doc_id == first[g]) for (doc_id, _), s, g in zip(rows, sets, group, strict=True)]


def family(seed, bases=12, copies=30, words=60):
    """Random texts, exact copies, and copies with a few to many words changed."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(bases):
        base = rng.choices(vocabulary, k=rng.randint(2, words))
        for _ in range(rng.choice([1, 2, copies])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,size", [(1, 4), (2, 5)])
def test_against_all_pairs(spark, docs, seed, size, monkeypatch):
    monkeypatch.setattr(near_duplicates, "PER_BLOCK", 8)
    rows = family(seed)
    got = near_duplicates.groups(spark, docs(rows), words=size).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, size, 80))


def test_dense_group_with_links_far_from_the_hub(spark, docs):
    """A chain: each text is linked with the next only, and the ends share little."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 80])) for i in range(30)]
    got = near_duplicates.groups(spark, docs(rows), words=4).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 4, 80))


def test_parts_of_exactly_the_least_size(spark, docs):
    """Copies of the first 80 % and of a little less: links at exactly 0.8 by containment, and none."""
    rows = []
    for n in range(1, 41):
        words = [f"t{n}w{i}" for i in range(5 * n + 3)]
        rows += [(10 * n, " ".join(words)), (10 * n + 1, " ".join(words[: 4 * n + 3])), (10 * n + 2, " ".join(words[: 4 * n + 2]))]
    got = near_duplicates.groups(spark, docs(rows), words=4).collect()
    expected = sorted(brute(rows, 4, 80))
    assert sorted(map(tuple, got)) == expected
    assert all(group == doc_id - 1 for doc_id, _, group, _ in expected if doc_id % 10 == 1)


@pytest.mark.parametrize("percent", [50, 70, 80, 90, 95])
def test_a_part_of_any_size_is_possible(percent):
    big = np.array([n for n in range(1, 20_001) if percent * n % 100 == 0])
    small = percent * big // 100
    same = np.full((len(big), 5), 7, np.uint16)
    for one, two in ((small, big), (big, small)):
        assert setsketch.similarity(same, same, one, two, percent / 100)[1].all()
        assert not setsketch.similarity(same, same, one - (one < two), two - (two < one), percent / 100)[1].any()


def test_edges(spark, docs, edge_rows):
    got = near_duplicates.groups(spark, docs(edge_rows), words=4).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert len(got) == len(edge_rows)
    assert by[1] == by[2][:0] + [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[4] == [(1, 4, True)] and by[5] == [(1, 4, False)] * 2
    assert by[None] == [(3, None, True)]
    assert by[6] == [(7, 6, True)] and by[7] == [(7, 6, False)]
    assert near_duplicates.groups(spark, docs([])).count() == 0


def test_drop_copies_keeps_all_columns(spark, docs):
    table = docs([(2, "a b c d e f g"), (1, "a b c d e f g"), (3, None), (None, "a b c d e f g")])
    left = near_duplicates.drop_copies(spark, table)
    assert left.columns == table.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 3]


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.8, 0.95):
        n, both = 500, int(1000 * share / (1 + share))
        found = []
        for _ in range(20):
            x = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
            r = setsketch.registers([x[:n], x[n - both :]], near_duplicates.REGISTERS)
            estimate, possible = setsketch.similarity(r[:1], r[1:], np.array([n]), np.array([n]), 0.8)
            found.append(estimate[0])
            assert possible[0] or share < 0.8
        assert abs(np.mean(found) - both / (2 * n - both)) < 0.03


def test_registers_of_a_union_are_maxima():
    rng = np.random.default_rng(6)
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (40, 700))
    r = setsketch.registers([a, b, np.union1d(a, b)], 29)
    assert (np.maximum(r[0], r[1]) == r[2]).all()


def test_shingles_of_short_and_long_texts():
    texts = ["", "One", "one TWO", "a b c d", "a\tb\nc  d e", "x " * 10]
    for text, found in zip(texts, shingle_sets(texts, 4), strict=True):
        assert len(found) == len(shingles(text, 4))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)]
    label = {x: x for e in edges for x in e}
    for a, b in edges * 1:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {k: new if v == old else v for k, v in label.items()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {n: label[n] for n in nodes}
    assert len(got) == len(nodes)


def test_rounds_over_few_edges_take_no_shuffle(spark, monkeypatch):
    """Edges from many partitions: each round of shrinking stars is one stage, of as many tasks as the edges need."""
    plans, real = [], store.keep
    monkeypatch.setattr(store, "keep", lambda s, df, label: (plans.append(df._jdf.queryExecution().toString()), real(s, df, label))[1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(20)
    got = components(spark, edges).collect()
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(301)]
    assert len(plans) > 2 and not any("Exchange hashpartitioning" in p for p in plans[1:])


@pytest.mark.parametrize("rows_a_task", [1, 16])
def test_groups_over_many_tasks(spark, docs, rows_a_task, monkeypatch):
    monkeypatch.setattr(near_duplicates, "PER_BLOCK", 8)
    monkeypatch.setattr(store, "ROWS_A_TASK", rows_a_task)
    rows = family(5)
    got = near_duplicates.groups(spark, docs(rows), words=4).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 4, 80))
