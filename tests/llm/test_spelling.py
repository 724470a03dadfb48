import random
import re
import zlib

import numpy as np
import pytest

from docsift.llm import spelling as sp
from docsift.llm import store

SCHEMA = "doc_id long, text string, word string, n int, length int, `a.b` int, best string, leaf int"


def brute_words(rows, every=None, least=6):
    out = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                out[run] = out.get(run, 0) + 1
    return out


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=5):
    near = {w: [x for x in counts if x != w and abs(len(x) - len(w)) < 2 and is_near(w, x)] for w in counts}
    best = {w: min(near[w], key=lambda x: (-counts[x], x)) for w in counts if near[w]}
    form = {w: b for w, b in best.items() if counts[b] >= ratio * counts[w]}
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, counts[w], len(near[w]), counts[f] if f else None))
    return sorted(out)


def mutated(rng, word):
    i, c = rng.randrange(len(word)), rng.choice("abcdeéß")
    return rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]])


def vocabulary(n, seed):
    rng = random.Random(seed)
    counts = {}
    while len(counts) < n:
        word = "".join(rng.choice("abcdeéß") for _ in range(rng.randrange(6, 11)))
        for _ in range(rng.randrange(1, 9)):
            counts.setdefault(word, rng.choice([5, 6, 30, 150, 900, 5000]))
            word = mutated(rng, word)
    return {w: c for w, c in counts.items() if len(w) >= 6}


def found(spark, counts):
    df = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    return sorted(map(tuple, sp.forms(spark, df).collect()))


@pytest.mark.parametrize("block, searches, sample", [(8192, 131_072, 65_536), (40, 70, 200), (3, 10, 5), (25, 30, 0)])
def test_against_all_pairs(spark, monkeypatch, block, searches, sample):
    store.settle(spark)
    monkeypatch.setattr(sp, "BLOCK", block)
    monkeypatch.setattr(sp, "SEARCHES", searches)
    monkeypatch.setattr(sp, "SAMPLE", sample)
    monkeypatch.setattr(sp, "LEAF", 4)
    counts = vocabulary(700, block)
    want = brute(counts)
    assert sum(r[1] is not None for r in want) > 100 and any(r[1] != r[2] for r in want if r[1])
    assert found(spark, counts) == want


def test_many_words_of_the_same_letters(spark, monkeypatch):
    """No level of a tree can part them: the leaf is dealt into slices."""
    store.settle(spark)
    monkeypatch.setattr(sp, "BLOCK", 50)
    rng = random.Random(8)
    counts = {"".join(rng.sample("abcdefgh", 8)): rng.choice([5, 100]) for _ in range(400)}
    counts |= {mutated(rng, w): 7 for w in list(counts)[:200]}
    assert found(spark, counts) == brute(counts)


def test_trees_leave_most_words_out():
    rng = np.random.default_rng(1)
    spelled = np.unique((rng.zipf(1.3, (60_000, 8)) % 26 + 97).astype(np.uint8), axis=0)
    tree = sp.LowerTree(spelled)
    pairs = [tuple(p) for i, j in tree.near(spelled[:300]) for p in zip(i.tolist(), j.tolist(), strict=True)]
    gaps = (spelled[:300, None, :] != spelled[None, :, :]).sum(axis=2)
    assert sorted(pairs) == sorted(zip(*(x.tolist() for x in np.nonzero(gaps == 1)), strict=True))
    assert tree.compared < 0.02 * gaps.size
    top = sp.TopTree(sp.letter_counts(spelled[::7]), 16)
    leaf = top.place(sp.letter_counts(spelled))
    rows, leaves = top.meet(sp.letter_counts(spelled[:300]), 1, 1)
    met = set(zip(rows.tolist(), leaves.tolist(), strict=True))
    assert top.n == 16 and len(met) == len(rows) and all((i, leaf[j]) in met for i, j in pairs)
    assert len(met) < 0.8 * 300 * 16


@pytest.mark.parametrize("every", [None, 2])
def test_edges(spark, edge_rows, every):
    store.settle(spark)
    rows = edge_rows + [
        (11, "Letter letter LETTER lettér LettÉr letters " * 6), (11, "letterx " * 2), (None, "letterx " * 3), (12, "×÷abcdef " * 5),
        (13, "abcdef-abcdef_abcdeg1abcdeg " * 3), (14, ("y" * 100_000 + " ") * 5), (15, ("y" * 99_999 + " ") * 30), (16, "œuvres \U0001f600" * 9),
    ]
    docs = spark.createDataFrame([(*r, "w", 1, 2, 3, "b", 4) for r in rows], SCHEMA)
    got = sorted(map(tuple, sp.variants(spark, docs, every=every).collect()))
    assert got == brute({w: n for w, n in brute_words(rows, every).items() if n >= 5})
    assert sp.variants(spark, docs.where("false")).collect() == []
