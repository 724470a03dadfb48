import numpy as np
import pytest
import regex

from docsift.llm import language
from docsift.llm.queries import QUERIES


def brute(text):
    """Sequences of one to three characters, counted by their strings."""
    text = regex.sub(r"\P{L}+", " ", text.lower()).lstrip()
    return sum(max(0, len(text) - n + 1) for n in (1, 2, 3))


def test_grams_count_every_sequence(monkeypatch):
    for text in ["", "a", "ab", "abc", "Äpfel und Birnen", "😀b", "!! a--b  c.", "...", "1 2"]:
        assert language.grams(text)[1].sum() == brute(text)
    text = "the quick, brown!! fox \n" * 50
    whole = language.grams(text)
    monkeypatch.setattr(language, "_PART", 37)
    parts = language.grams(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_held_out_accuracy(spark):
    rows = QUERIES["op4_language"](spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = rows.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(held) > 250 and (held.lang_pred == held.lang).mean() >= 0.98
    assert both.score.between(0, 1).all()


@pytest.fixture
def model(spark):
    rows = [(i, t, lang) for i in range(40) for t, lang in (("the cat and the dog", "en"), ("der Hund und die Katze", "de"))]
    rows += [(None, "xx", "fr"), (900, None, "fr"), (901, "yy", None)]
    return language.fit(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_weights_are_sparse_and_edges_are_defined(spark, docs, model, edge_rows):
    assert model.names == ["de", "en"]
    assert 0 < np.count_nonzero(model.weights) < language.BUCKETS / 10
    got = language.predicted(docs(edge_rows + [(20, "123 !"), (21, "und die Katze"), (22, "and the cat")]), model).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(edge_rows) + 3
    assert by[1] == by[2] == by[3] == by[20] == ("und", 0.0)
    assert by[21][0] == "de" and by[22][0] == "en" and 0.5 <= by[21][1] <= 1


def test_nothing_to_learn_from(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.fit(spark, empty)
    assert [tuple(r) for r in language.predicted(docs([(1, "text")]), model).collect()] == [(1, "und", 0.0)]
    assert language.predicted(docs([]), model).count() == 0


@pytest.mark.parametrize("ids", ["one", "many"])
def test_the_sample_is_bounded_and_repeatable(spark, monkeypatch, ids):
    """Rows that share an id, or are equal, neither flood the sample nor leave it empty."""
    monkeypatch.setattr(language, "SAMPLE", 60)
    texts = [(1 if ids == "one" else i, f"the cat number {'abcdefghij'[i % 10]}" if i % 2 else "the dog", "en") for i in range(3000)]
    texts += [(1 if ids == "one" else -i, f"der Hund {'klmnopqrst'[i % 10]}", "de") for i in range(50)]
    seen, fitted = [], language.ftrl
    monkeypatch.setattr(language, "ftrl", lambda v, y, k: (seen.append(np.bincount(y, minlength=k).tolist()), fitted(v, y, k))[1])
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    one, two = language.fit(spark, df), language.fit(spark, df.repartition(5))
    assert sum(seen[0]) == 48 and seen[0] == seen[1]  # four fifths of 30 of each
    assert (one.weights == two.weights).all() and one.temperature == two.temperature
    assert one.predict("the cat")[0] == "en" and one.predict("der Hund")[0] == "de"


def test_ftrl_against_plain_arithmetic(monkeypatch):
    """The weights coordinate by coordinate, as the update is written down."""
    import math

    monkeypatch.setattr(language, "BUCKETS", 7)
    rng = np.random.default_rng(2)
    vectors = [(np.sort(rng.choice(7, 3, replace=False)), rng.random(3)) for _ in range(30)]
    y = rng.integers(0, 3, 30)
    z, n = [[0.0] * 3 for _ in range(7)], [[0.0] * 3 for _ in range(7)]

    def weight(zi, ni):
        if abs(zi) <= language.L1:
            return 0.0
        return -(zi - math.copysign(language.L1, zi)) / ((language.SMOOTH + math.sqrt(ni)) / language.RATE + language.L2)

    for _ in range(language.EPOCHS):
        for (at, x), label in zip(vectors, y, strict=True):
            w = [[weight(z[i][c], n[i][c]) for c in range(3)] for i in at]
            s = [sum(xi * wi[c] for xi, wi in zip(x, w, strict=True)) for c in range(3)]
            p = [math.exp(v - max(s)) for v in s]
            for i, xi, wi in zip(at, x, w, strict=True):
                for c in range(3):
                    g = xi * (p[c] / sum(p) - (c == label))
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / language.RATE * wi[c]
                    n[i][c] += g * g
    want = np.array([[weight(z[i][c], n[i][c]) for c in range(3)] for i in range(7)])
    assert np.allclose(language.ftrl(vectors, y, 3), want, atol=1e-12)
