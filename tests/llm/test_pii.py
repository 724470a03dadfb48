import hashlib
import random
import re

from docsift.llm import pii, store
from docsift.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(spark, docs, rows):
    got = pii.report(pii.find(spark, docs(rows))).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(got) == len(rows)
    for doc_id, text in rows:
        expected, r = brute(text), by[doc_id][0]
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest(), (doc_id, text, r)
        assert [r[f"n_{k}"] for k in BASE] == [sum(x.startswith(k) for x in expected) for k in BASE]
        assert set(expected) <= set(r["spans"].split(","))
    return by


def test_base_spans_of_random_texts(spark, docs):
    rng = random.Random(3)
    letters = "ab1.2@-_+% ()3\n45é.@@  00--😀"
    check(spark, docs, [(i, "".join(rng.choices(letters, k=rng.randrange(70)))) for i in range(2000)])


def test_edges_and_long_runs(spark, docs):
    rows = [
        (1, None), (2, ""), (None, "a@b.cd"), (3, "4041894974608795 4041-8949-7460-8795 1.2.3.4.5.6.7.8 256.1.1.1"),
        (4, "a@b@c.d a@b.c..d@e.f 😀 x.y@z.w a@b.c.+d@e.f"), (5, "1 " * 20_000), (6, "a@" + "b." * 20_000), (7, "1." * 20_000),
        (8, "9" * 50_000), (9, "x" * 50_000 + "@a.b"), (10, "+1 " * 10_000), (11, "+1 (743) 555-3824 +123 +1234567890123456"),
        (12, "same a@b.cd"), (12, "same a@b.cd"),
    ]
    check(spark, docs, rows)
    assert pii.report(pii.find(spark, docs([]))).count() == 0


def test_contexts_reveal_identifiers_that_base_patterns_miss(spark, docs):
    rows = []
    for i in range(200):
        phone, mail = (f"743-555-{1000 + i}", f"root{i}@localhost") if i % 10 == 9 else (f"+1 (743) 555-{1000 + i}", f"u{i}@mail.example")
        rows.append((i, f"lorem ipsum contact phone: {phone} ok. email to {mail} please"))
    rows += [(500 + i, f"order 743-555-{2000 + i} shipped") for i in range(20)]
    by = check(spark, docs, rows)
    text = dict(rows)
    for i in range(9, 200, 10):
        found = {k: text[i][int(a) : int(b)] for k, a, b in (s.split(":") for s in by[i][0]["spans"].split(","))}
        assert found == {"phone": f"743-555-{1000 + i}", "email": f"root{i}@localhost"}
    assert all(by[500 + i][0]["spans"] == "" for i in range(20))


def test_what_is_found_opens_new_patterns(spark, docs):
    """Ten identifiers stand beside seeds, then in a context of their own with ten that meet no seed."""
    rows = [(i, f"call me: +1 (743) 555-{1000 + i} now") for i in range(60)]
    rows += [(100 + i, f"call me: 743-555-{2000 + i} now") for i in range(10)]
    rows += [(200 + i, f"fax desk 743-555-{2000 + i} daily") for i in range(10)]
    rows += [(300 + i, f"fax desk 743-555-{3000 + i} daily") for i in range(2)]
    rows += [(400 + i, f"order no 743-555-{4000 + i} shipped") for i in range(20)]
    by = check(spark, docs, rows)
    for i in [*range(100, 110), *range(200, 210), 300, 301]:
        [span] = by[i][0]["spans"].split(",")
        kind, a, b = span.split(":")
        assert (kind, dict(rows)[i][int(a) : int(b)][:8]) == ("phone", "743-555-")
    assert all(by[400 + i][0]["spans"] == "" for i in range(20))


def test_no_python_runs_in_tasks(spark, capsys):
    store.settle(spark)
    frame = QUERIES["op8_pii"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan += pii.located(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_many_matches_in_one_text(spark, docs):
    """Work grows with the matches, not with their square."""
    import time

    text = "12 34.5 a@b.co +1 (23) " * 40_000
    start = time.time()
    got = pii.report(pii.find(spark, docs([(1, text)]))).collect()
    assert got[0]["n_email"] == 40_000 and time.time() - start < 120
    small = text[: 23 * 300]
    check(spark, docs, [(1, small), (2, small)])


def test_words_around_are_whole(spark, docs):
    """However long the word beside a span, and however far the one before it."""
    word, space = "w" * 500, " " * 300
    text = f"{space}first {word}{space}7@7.co {word.upper()} x 1.2.3.4\tend"
    around = pii.located(docs([(1, text)]).select("doc_id", "text")).selectExpr("explode(around) AS x").select("x.*").collect()
    found = {r["value"]: (r["l2"], r["l1"], r["r1"]) for r in around if r["seed"]}
    assert found == {"7@7.co": ("first", word, word), "1.2.3.4": (word, "x", "end")}
