
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsift.operators import chunk, clean, parse, recursive

TEXTS = st.text(alphabet=st.sampled_from("ab é.\n=p🙂 "), max_size=300)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(2, 40), st.integers(0, 10))
def test_split_invariants(text, size, overlap):
    overlap = min(overlap, size - 1)
    chunks = recursive.split_text(text, size, overlap, recursive.PAGE_SEPARATORS)
    assert all(0 < len(c) <= size and c.strip() == c and c in text for c in chunks)
    # nothing is lost: every character but blanks lies in some chunk, in order
    at, covered = 0, set()
    for c in chunks:
        at = text.index(c, max(0, at - size))
        covered.update(range(at, at + len(c)))
    if overlap == 0:
        assert "".join("".join(c.split()) for c in chunks) == "".join(text.split())


def test_split_prefers_early_separators():
    text = "one two\n== page ==\nthree four"
    assert recursive.split_text(text, 25, 0, recursive.PAGE_SEPARATORS) == ["one two", "== page ==\nthree four"]
    assert recursive.split_text("word " * 3, 100, 10) == ["word word word"]


def test_split_overlap_is_whole_pieces():
    # a piece keeps the blank before it, so " cc dd ee" would be 9 long
    assert recursive.split_text("aa bb cc dd ee", 8, 3) == ["aa bb cc", "cc dd", "dd ee"]
    assert recursive.split_text("aa bb cc dd ee", 9, 3) == ["aa bb cc", "cc dd ee"]
    assert recursive.split_text("aa bb cc dd ee", 8, 2) == ["aa bb cc", "dd ee"]


def test_split_long_word_and_missing_fallback():
    assert [len(c) for c in recursive.split_text("x" * 25, 10, 2)] == [10, 10, 9]
    assert recursive.split_text("x" * 25 + " y", 10, 0, (" ",)) == ["x" * 25, "y"]
    for blank in (None, "", " \n "):
        assert recursive.split_text(blank) == []
    with pytest.raises(ValueError):
        recursive.split_text("a", 10, 10)


def test_table_and_scalar_forms_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = recursive.split_documents(docs, "doc_id", "text", 300, 50)
    two = recursive.split_column(docs.repartition(7), "doc_id", "text", 300, 50)
    rows = sorted(map(tuple, one.collect()))
    assert rows == sorted(map(tuple, two.collect()))
    assert recursive.oversized(one, 300).count() == 0
    positions = {}
    for key, pos, _ in rows:
        positions.setdefault(key, []).append(pos)
    assert all(p == list(range(len(p))) for p in positions.values())


def test_fixed_chars_covers_the_text(spark):
    texts = ["", "short", "x" * 10, "é🙂" * 30, "a\nb" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    for size, overlap in ((10, 0), (10, 3), (10, 9), (7, 5)):
        rows = chunk.fixed_chars(df, ["k"], "text", size, overlap).orderBy("k", "pos").collect()
        for k, text in enumerate(texts):
            mine = [r["chunk"] for r in rows if r["k"] == k]
            stride = size - overlap
            want = [text[i : i + size] for i in range(0, max(len(text) - size, 0) + stride, stride)] if text else []
            want = [w for i, w in enumerate(want) if i == 0 or (i - 1) * stride + size < len(text)]
            assert mine == want


def test_blank_and_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "a. b")], "k int, text string")
    for rows in (
        chunk.by_sentences(df, ["k"], "text"),
        chunk.fixed_tokens(df, ["k"], "text", 5, 1),
        chunk.by_pages(df, ["k"], "text"),
        chunk.semantic(df, ["k"], "text", 0.5),
        chunk.packed_sentences(df, "k", "text", 10),
        chunk.nonblank(df, "text"),
    ):
        assert {r["k"] for r in rows.collect()} == {4}


def test_page_marks(spark):
    df = spark.createDataFrame(
        [(1, "== page ==\na\n== page ==\n== page ==\nb"), (2, "no mark")], "k int, text string"
    )
    rows = chunk.by_pages(df, ["k"], "text").orderBy("k", "pos").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a"), (1, 1, "b"), (2, 0, "no mark")]


def test_mark_inside_text_is_softened(spark):
    rows = [("d", 1, 0, "x == page == y"), ("d", 2, 0, "z")]
    df = spark.createDataFrame(rows, "path string, page int, pos int, content string")
    text = clean.plain_text(df).first()["plain_text"]
    assert text.split(clean.PAGE_MARK) == ["x = = page = = y", "z"]


def test_a_path_is_one_text_however_many_pages_it_has(spark):
    rows = spark.range(10_001).selectExpr("'d' AS path", "CAST(id AS int) AS page")
    rows = rows.selectExpr("path", "page", "explode(array(0, 1)) AS pos").selectExpr("*", "concat(page, pos) AS content")
    text = clean.plain_text(rows.repartition(4)).collect()
    assert len(text) == 1
    assert text[0]["plain_text"] == clean.PAGE_MARK.join(f"{p}0\n{p}1" for p in range(10_001))
    pieces = chunk.by_pages(clean.plain_text(rows), ["path"], "plain_text")
    assert pieces.select("path", "pos").distinct().count() == 10_001
    assert parse.parsed_documents(
        rows.selectExpr("path", "page", "pos", "'text' AS type", "'body' AS region", "content")
    ).count() == 1


def test_all_heading_levels_reach_the_path(spark):
    text = "\n".join(f"{'#' * n} h{n}\nx" for n in range(1, 7))
    rows = chunk.by_headers(spark.createDataFrame([(1, text)], "k int, text string"), ["k"], "text").orderBy("pos")
    assert rows.collect()[-1]["heading_path"] == " > ".join(f"h{n}" for n in range(1, 7))


def test_packed_sentences(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = chunk.packed_sentences(docs, "doc_id", "text", 400).collect()
    parts = {(r["doc_id"], r["pos"]): r["chunk"] for r in chunk.by_sentences(docs, ["doc_id"], "text").collect()}
    whole = {}
    for (key, _), part in sorted(parts.items()):
        whole.setdefault(key, []).append(part)
    again = {}
    for r in sorted(packed, key=lambda r: (r["doc_id"], r["pos"])):
        again.setdefault(r["doc_id"], []).append(r["chunk"])
        assert len(r["chunk"]) <= 400 or r["chunk"] in whole[r["doc_id"]]
    assert {k: " ".join(v) for k, v in whole.items()} == {k: " ".join(v) for k, v in again.items()}


def test_heading_path(spark):
    text = "intro\n# A\nx\n### deep\ny\n## B\nz\n# C\n## D\nw"
    df = spark.createDataFrame([(1, text)], "k int, text string")
    rows = chunk.by_headers(df, ["k"], "text").orderBy("pos").collect()
    assert [r["heading_path"] for r in rows] == ["", "A", "A > deep", "A > B", "C", "C > D"]


def test_context_window_policies(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b")], "k int, text string")
    cut = {r["k"]: r["chunk"] for r in chunk.fit(df, ["k"], "text", 3, "truncate").collect()}
    assert cut == {1: "a b c", 2: "a b"}
    parts = [r["chunk"] for r in chunk.fit(df, ["k"], "text", 3, "split").orderBy("k", "pos").collect()]
    assert parts == ["a b c", "d e", "a b"]
    with pytest.raises(Exception, match="more than 3 tokens"):
        chunk.fit(df, ["k"], "text", 3, "error").collect()


def test_ids_do_not_depend_on_partitioning(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    def ids(n):
        pieces = chunk.fixed_chars(docs.repartition(n), ["doc_id"], "text", 500, 100)
        return {tuple(r) for r in chunk.chunk_ids(pieces, ["doc_id", "pos"]).select("doc_id", "pos", "id").collect()}

    first = ids(3)
    assert first == ids(5)
    assert len({i for *_, i in first}) == len(first)


def test_size_study_matches_real_chunks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for row in chunk.size_study(docs, "text", [(300, 60), (1000, 200)]).collect():
        cut = chunk.fixed_chars(docs, ["doc_id"], "text", row["size"], row["overlap"])
        n, chars = cut.agg(F.count("*"), F.sum(F.length("chunk"))).first()
        assert (row["n_chunks"], row["mean_chars"]) == (n, round(chars / n, 6))


def test_packing_many_sentences(spark):
    """Work grows with the sentences of a text, not with their square."""
    import time

    def brute(sentences, size):
        out, held = [], None
        for s in sentences:
            if held is not None and len(held) + 1 + len(s) <= size:
                held = f"{held} {s}"
            else:
                out += [] if held is None else [held]
                held = s
        return out + ([] if held is None else [held])

    texts = {0: "", 1: None, 2: "One. " * 257, 3: " ".join(f"Sentence {i}{'x' * (i % 50)}." for i in range(3000))}
    df = spark.createDataFrame(list(texts.items()), "k int, text string")
    got = {}
    for r in chunk.packed_sentences(df, "k", "text", 60).orderBy("k", "pos").collect():
        got.setdefault(r["k"], []).append(r["chunk"])
    assert got == {k: brute([s + "." for s in texts[k].strip(". ").replace(". ", ".").split(".")], 60) for k in (2, 3)}
    start = time.time()
    many = spark.createDataFrame([(1, "Go. " * 200_000)], "k int, text string")
    assert chunk.packed_sentences(many, "k", "text", 20).count() == 40_000 and time.time() - start < 60
