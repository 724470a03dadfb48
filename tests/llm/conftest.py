import pytest

from docsift.llm import store

CLASH = {"n_tokens": 7, "kept": "x", "size": 1, "key": 2, "mark": 3, "template": 4, "lines": "y", "start": 5, "text2": "z",
         "a.b": 6, "doc_id.text": 7, "__items": 8, "__lines": 9, "__of": 10, "__blank": 11, "gone": 12, "c0": 13, "c`d": 14}


@pytest.fixture
def docs(spark):
    """A table of documents with extra columns whose names operators use inside."""
    store.settle(spark)

    def make(rows):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        return df.select("*", *(F.lit(v).alias(k) for k, v in CLASH.items()))

    return make


@pytest.fixture
def edge_rows():
    """Null and repeated ids, null, empty, blank, tied and very long texts."""
    long = " ".join(f"word{i % 977} and" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two three four five six"),
        (6, "a b c d e f g h i j"), (7, "a b c d e f g h i j"), (8, long), (9, "x" * 300_000), (10, "é" * 10 + "\n" * 50),
    ]
