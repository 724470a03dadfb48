import random

import numpy as np

from docsift.llm import pretoken, quality
from docsift.llm.queries import QUERIES

GOOD = "The house on the hill was old, and nobody lived in it. A road led down to the sea."
BAD = "BUY!! NOW!! *** CHEAP$$$ ### CLICK!! | HERE | ***"


def test_held_out_accuracy(spark):
    rows = QUERIES["op7_quality"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(held) > 500 and (held.predicted == held.quality).mean() >= 0.98
    assert held[held.quality == 1].predicted.mean() >= 0.99
    assert (rows.predicted == (rows.score >= 0.3)).all() and rows.score.between(0, 1).all()


def texts(n, seed=1):
    """Sentences of made-up words, and shouted or decorated ones."""
    rng = random.Random(seed)
    for i in range(n):
        words = ["".join(rng.choices("aeinorst", k=rng.randint(1, 9))) for _ in range(rng.randint(5, 80))]
        sentences = [" ".join(words[j : j + 9]).capitalize() + "." for j in range(0, len(words), 9)]
        yield rng.choice(["\n", " "]).join(sentences), 1
        yield " ".join(w + rng.choice(["***", "$$$", "!!", " |"]) for w in words), 0


def labelled(spark, docs, pairs):
    rows = [(i, t) for i, (t, _) in enumerate(pairs)]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(pairs)], "doc_id long, y int")
    return docs(rows), labels


def test_small_classes_and_edges(spark, docs, edge_rows):
    table, labels = labelled(spark, docs, list(texts(60)))
    # Both labels, no id, no label, another label: none of these is learned from.
    noise = spark.createDataFrame([(0, 0), (None, 1), (5, None), (6, 7)], "doc_id long, y int")
    model = quality.fit(spark, quality.measured(table), labels.union(noise))
    got = quality.scored(quality.measured(docs(edge_rows + [(50, GOOD), (51, BAD)])), model).collect()
    by = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == len(edge_rows) + 2 and by[50] > 0.5 and by[51] < 0.1
    assert all(np.isfinite(s) and 0 <= s <= 1 for s in by.values()) and by[1] == by[2]
    assert quality.scored(quality.measured(docs([])), model).count() == 0


def test_a_missing_class_gives_its_share(spark, docs):
    for pairs, score in (([(GOOD, 1)] * 3, 1.0), ([], 0.5)):
        table, labels = labelled(spark, docs, pairs)
        model = quality.fit(spark, quality.measured(table), labels)
        assert [r["score"] for r in quality.scored(quality.measured(docs([(1, "x")])), model).collect()] == [score]


def test_keep_good_passes_all_columns(spark, docs):
    table, labels = labelled(spark, docs, list(texts(60)))
    left = quality.keep_good(spark, table, labels)
    assert left.columns == table.columns
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(0, 120, 2))


def test_statistics_of_a_cut_text_are_those_of_the_whole(monkeypatch):
    text = (GOOD + " " + BAD + "\n") * 50
    whole = quality.statistics([text, GOOD])
    monkeypatch.setattr(quality, "chunked", lambda t: pretoken.chunked(t, 300))
    assert np.allclose(quality.statistics([text, GOOD]), whole)
