import random
import re

import pyarrow as pa

from docsift.llm import decontaminate


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items):
    found = []
    for doc_id, text in rows:
        w = words(text)
        hit, of = set(), set()
        for item, other in items:
            v = words(other)
            if item is None or not v:
                continue
            n = min(13, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    of.add(str(item))
        found.append((doc_id, len(w), len(hit), sorted(of)))
    return found


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, lang int")


def check(spark, docs, rows, items):
    got = decontaminate.find(spark, docs(rows), table(spark, [(*i, 1) for i in items])).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got], key=key) == sorted(brute(rows, items), key=key)
    return got


def planted(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "É", "x1", "don't", "日本", "Z"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 5, 13, 14, 20])))) for i in range(25)]
    rows = []
    for i in range(60):
        parts = rng.choices(vocabulary, k=rng.randrange(20))
        if i % 2:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(items)[1].upper().replace(" ", rng.choice([", ", "\n", "  "])))
        rows.append((i, " ".join(parts)))
    return rows, items


def test_against_brute_force(spark, docs):
    check(spark, docs, *planted(1))


def test_several_automata_give_the_same(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "AUTOMATON_CHARS", 150)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    rows, items = planted(2)
    check(spark, docs, rows, items)
    groups = decontaminate.window_groups(spark, table(spark, [(*i, 1) for i in items]))
    sizes = [sum(len(w) + len(i) for w, i in decontaminate._pairs_of(g)) for g in groups]
    assert len(groups) > 5 and max(sizes) < 6 * 150


def test_blocks_hold_a_bounded_number_of_characters():
    texts = [None, "a" * 40, "b" * 70, "c" * 500, "", "é" * 10, "d" * 30]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 3])], names=["t"]) for i in (0, 3, 6)]
    blocks = [[t for b in block for t in b.column(0).to_pylist()] for block in decontaminate._blocks(iter(batches), 0, 100)]
    assert [t for b in blocks for t in b] == texts
    assert [len(b) for b in blocks] == [3, 1, 3]


def test_edges(spark, docs, edge_rows):
    items = [(1, None), (None, "one"), (2, "..."), (3, "one"), (3, "two three"), (3, "one"), (10, "a b c d e f g h i j")]
    check(spark, docs, edge_rows, items)
    check(spark, docs, edge_rows, [])
    check(spark, docs, [], items)


def test_spans_are_places_in_the_original(spark, docs):
    text = "Ünder: the Quick--brown 😀 fox; end"
    [row] = decontaminate.find(spark, docs([(1, text)]), table(spark, [(7, "the quick brown", 0)])).collect()
    [span] = row["spans"]
    assert text[span["start"] : span["end"]] == "the Quick--brown"
    assert (span["first"], span["last"], row["n_hit"]) == (1, 3, 3)


def test_rule_and_filter(spark, docs):
    rows = [(1, "x " * 19 + "bad"), (2, "x " * 20 + "bad"), (3, None), (None, "bad"), (4, "")]
    left = decontaminate.drop_contaminated(spark, docs(rows), table(spark, [(1, "bad", 0)]))
    assert left.columns == docs(rows).columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
