import re

from pyspark.sql import functions as F

from docsift.llm import line_templates as lt


def brute(rows, min_docs=2, short=None):
    """Texts left, by templates as strings."""
    short = lt.SHORT if short is None else short
    keys, docs_of = {}, {}
    for doc_id, text in rows:
        for j, line in enumerate((text or "").split("\n")):
            words = [w for w in re.split(r"[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in line)) if w]
            words = ["<*>" if re.search("[0-9]", w) else w for w in words]
            n, own = len(words), []
            if n >= short:
                own.append((n, tuple(words)))
            if n >= lt.GENERAL:
                rest = n - lt.LEAD
                for i in range(lt.FIELDS):
                    c, d = lt.LEAD + rest * i // lt.FIELDS, lt.LEAD + rest * (i + 1) // lt.FIELDS
                    if d > c:
                        own.append((n, i, tuple(words[:c]), tuple(words[d:])))
            keys[doc_id, j] = (own, n)
            for k in own:
                if doc_id is not None:
                    docs_of.setdefault(k, set()).add(doc_id)
    out = {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = {
            j for j in range(len(lines)) if doc_id is not None
            and any(len(docs_of[k]) >= min_docs and min(docs_of[k]) < doc_id for k in keys[doc_id, j][0])
        }
        left = text if text is None else "\n".join(x for j, x in enumerate(lines) if j not in gone)
        out[doc_id] = (left, sum(keys[doc_id, j][1] > 0 for j in range(len(lines))), len(gone))
    return out


ROWS = [
    (1, "Order 17 was sent to you on 3 May\nonly here are some words of mine"),
    (2, "order 99 was sent to you on 4 may\n\nanother text that nobody else has at all"),
    (3, "alpha beta gamma one two three four five six seven eight\nshort line here"),
    (4, "alpha beta gamma one two three four FIVE other seven eight\nshort line here"),
    (5, "alpha beta gamma one two CHANGED four five six seven changed\nshort line here"),
    (6, "again again again again again\nagain again again again again"),
    (7, None), (8, ""), (9, "\n \n"),
    (None, "Order 17 was sent to you on 3 May"),
]


def left(spark, docs, rows, **more):
    got = lt.dedup_lines(spark, docs(rows), **more)
    return {r["doc_id"]: (r["text"], r["__n_lines"], r["__n_dropped"]) for r in got.collect()}


def test_handmade(spark, docs):
    got = left(spark, docs, ROWS)
    assert got == brute(ROWS)
    assert got[1][0] == ROWS[0][1] and got[2][0] == "\nanother text that nobody else has at all"
    assert got[4] == ("short line here", 2, 1)  # one fifth differs
    assert got[5][2] == 0  # two fifths differ
    assert got[6] == (ROWS[5][1], 2, 0)  # repeated in one document only
    assert got[None][2] == 0


def test_short_lines_go_if_none_are_exempt(spark, docs, monkeypatch):
    rows = [(1, "All rights reserved.\nalpha"), (2, "beta\nall rights reserved.\nPage 3"), (3, "Page 4\n\ngamma"), (4, "alpha")]
    assert left(spark, docs, rows)[4] == ("alpha", 1, 0)
    got = left(spark, docs, rows, short=1)
    assert got == {1: (rows[0][1], 2, 0), 2: ("beta\nPage 3", 3, 1), 3: ("\ngamma", 2, 1), 4: ("", 1, 1)}
    monkeypatch.setattr(lt, "SHORT", 1)
    assert got == brute(rows) and left(spark, docs, ROWS, short=1) == brute(ROWS)


def test_the_pipeline_exempts_no_line(spark, docs):
    import corpus_pipeline

    rows = [(1, "one\nAll rights reserved."), (2, "two\nAll rights reserved."), (3, "All rights reserved.")]
    kept = corpus_pipeline.drop_recurring_lines(spark, docs(rows), "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, rows[0][1]), (2, "two")]


def test_more_documents_asked_for(spark, docs):
    assert left(spark, docs, ROWS, min_docs=3)[2][2] == 0


def test_long_passage_in_a_third_of_all_rows(spark, docs):
    passage = " ".join(f"w{i}x" if i % 7 else str(i) for i in range(60))
    rows = [(i, (passage if i % 3 == 0 else f"text number {i} is about nothing in particular") + f"\nown{i}") for i in range(300)]
    got = left(spark, docs, rows)
    assert sum(passage in t for t, _, _ in got.values()) == 1
    assert passage in got[0][0]
    assert all(t.endswith(f"own{i}") for i, (t, _, _) in got.items())


def test_edges(spark, docs, edge_rows):
    rows = [r for r in edge_rows if r[0] != 5]
    assert left(spark, docs, rows) == brute(rows)
    table = docs(edge_rows)
    got = lt.dedup_lines(spark, table)
    assert got.columns[: len(table.columns)] == table.columns and got.count() == len(edge_rows)
    assert lt.dedup_lines(spark, docs([])).count() == 0


def test_drop_recurring_passes_columns_of_any_name(spark, docs):
    table = docs([(1, "a b c\nown one"), (2, "a b c"), (3, "a b c\nown two"), (None, "a b c"), (4, None), (5, "")])
    table = table.select("*", F.lit(99).alias("n_chars"))
    left = lt.drop_recurring(spark, table, length_col="n_chars")
    assert left.columns == table.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["a.b"], r["__blank"], r["c0"]) for r in left.collect()}
    same = (6, 11, 13)
    assert got == {1: ("a b c\nown one", 99, *same), 3: ("own two", 7, *same), None: ("a b c", 99, *same),
                   4: (None, 99, *same), 5: ("", 99, *same)}


def test_long_texts_are_cut_without_loss():
    text = "\n".join(" ".join(f"v{i}w{j}" if (i + j) % 2 else "word" for j in range(12)) for i in range(9000))
    text_no, line, size, keys = lt.line_keys(["a b c d e f", text, "g h i j k l"])
    assert line.tolist() == [0, *range(9000), 0] and set(size.tolist()) == {6, 12}
    alone = lt.line_keys([text.split("\n")[8999]])[3]
    assert (keys[-2] == alone[0]).all()
