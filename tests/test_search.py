import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.functions import vectors as vx
from docsift.operators import cells, changes, chunk, embed, lexical, rank, topk
from docsift.plans import filters as flt
from docsift.plans import index as ix
from docsift.plans import search as se


def brute(metric, queries, vectors, k):
    out = []
    for q, a in queries.items():
        scored = []
        for key, b in vectors.items():
            a_, b_ = np.array(a, float), np.array(b, float)
            if metric == "cosine":
                length = np.linalg.norm(a_) * np.linalg.norm(b_)
                if length == 0:
                    continue
                scored.append((-round(float(a_ @ b_ / length), 6), key))
            else:
                scored.append((round(float(np.linalg.norm(a_ - b_, 2 if metric == "l2" else 1)), 6), key))
        for r, (cost, key) in enumerate(sorted(scored)[:k], 1):
            out.append((q, key, abs(cost) if metric != "cosine" else -cost + 0.0, r))
    return sorted(out)


@pytest.mark.parametrize("metric", ["cosine", "l2", "l1"])
@pytest.mark.parametrize("text_keys", [False, True])
def test_nearest_equals_brute_force(spark, metric, text_keys):
    rng = np.random.default_rng(3)
    # small integers make many exact ties; one zero vector
    points = rng.integers(-1, 2, size=(200, 4)).astype(float)
    points[0] = 0
    name = (lambda i: f"k{i:03d}") if text_keys else (lambda i: i)
    vectors = {name(i): p.tolist() for i, p in enumerate(points)}
    queries = {i: rng.integers(-1, 2, size=4).astype(float).tolist() for i in range(9)}
    kind = "string" if text_keys else "bigint"
    v = spark.createDataFrame(list(vectors.items()), f"key {kind}, vector array<float>").repartition(5)
    q = spark.createDataFrame(list(queries.items()), "query_id bigint, vector array<float>")
    want = brute(metric, queries, vectors, 7)
    for batch in (4096, 4):
        got = topk.nearest(v, q, 7, metric, batch_queries=batch)
        assert sorted((r["query_id"], r["key"], r["score"], r["rank"]) for r in got.collect()) == want


def test_fewer_rows_than_k_and_no_rows(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, vector array<float>")
    v = spark.createDataFrame([(5, [2.0, 0.0])], "key bigint, vector array<float>")
    assert topk.nearest(v, q, 10).count() == 1
    assert topk.nearest(v.filter("key < 0"), q, 10).count() == 0
    assert topk.nearest(v, q.filter("query_id < 0"), 10).count() == 0


def test_all_cells_is_exact_and_counts_are_right(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    v = e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    q = v.select(F.col("key").alias("query_id"), "vector")
    centres = cells.train_cells(v, "vector", 500, 8)
    celled = v.withColumn("cell", cells.cell_of(F.col("vector"), centres))
    asking = q.withColumn("probes", cells.nearest_cells(F.col("vector"), centres, 8))
    exact = sorted(map(tuple, topk.nearest(v, q, 5).collect()))
    assert sorted(map(tuple, topk.nearest(celled, asking, 5, within="cells").collect())) == exact
    few = q.withColumn("probes", cells.nearest_cells(F.col("vector"), centres, 2))
    sizes = {r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}
    want = {r["query_id"]: sum(sizes[c] for c in r["probes"]) for r in few.collect()}
    got = topk.nearest(celled, few, 5, within="cells", count_only=True)
    assert {r["query_id"]: r["n_scored"] for r in got.collect()} == want


def test_recall_grows_with_probes(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    v = e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    q = v.select(F.col("key").alias("query_id"), "vector")
    centres = cells.train_cells(v, "vector", 500, 16)
    celled = v.withColumn("cell", cells.cell_of(F.col("vector"), centres)).cache()
    exact = topk.nearest(v, q, 10).cache()
    values = []
    for n in (1, 4, 16):
        asking = q.withColumn("probes", cells.nearest_cells(F.col("vector"), centres, n))
        found = topk.nearest(celled, asking, 10, within="cells")
        values.append(rank.recall(found, exact).agg(F.avg("recall")).first()[0])
    assert values[0] < values[1] < values[2] == 1.0


def test_bands_score_only_colliding_pairs(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    v = e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    v = v.withColumn("bands", cells.band_keys(F.col("vector"), 64, 4, 6))
    q = v.withColumnRenamed("key", "query_id")
    bands = {r["key"]: set(r["bands"]) for r in v.collect()}
    want = {a: sum(bool(x & y) for y in bands.values()) for a, x in bands.items()}
    got = topk.nearest(v, q, 5, within="bands", count_only=True)
    assert {r["query_id"]: r["n_scored"] for r in got.collect()} == want
    for r in topk.nearest(v, q, 5, within="bands").collect():
        assert bands[r["query_id"]] & bands[r["key"]]


TEXTS = ["red fox red", "blue fox", "", "green tree fox", "red red red tree", "fox"]


def test_bm25_equals_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "k bigint, text string")
    asked = {0: "red fox fox", 1: "tree unknown", 2: "nothing"}
    queries = spark.createDataFrame(list(asked.items()), "query_id bigint, query_text string")
    posts = lexical.postings(docs, "k", "text")
    weighted = lexical.weighted_queries(
        lexical.query_terms(queries, "query_text"), lexical.document_frequency(posts), len(TEXTS)
    )
    avg = sum(len(t.split()) for t in TEXTS) / len(TEXTS)
    got = topk.bm25(posts, weighted, 3, avg)
    want = []
    for q, text in asked.items():
        scored = []
        for k, doc in enumerate(TEXTS):
            words, score = doc.split(), 0.0
            for t in set(text.split()):
                df = sum(t in d.split() for d in TEXTS)
                tf = words.count(t)
                if tf:
                    idf = math.log(1 + (len(TEXTS) - df + 0.5) / (df + 0.5))
                    score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
            if score:
                scored.append((-round(score, 6), k))
        want += [(q, k, -s, r) for r, (s, k) in enumerate(sorted(scored)[:3], 1)]
    assert sorted((r["query_id"], r["key"], r["score"], r["rank"]) for r in got.collect()) == want
    blocks = topk.bm25(posts, weighted, 3, avg, batch_queries=1)
    assert sorted((r["query_id"], r["key"], r["score"], r["rank"]) for r in blocks.collect()) == want


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = df.select(
        vx.norm(F.col("a")), vx.cosine(F.col("a"), F.col("z")), vx.l2(F.col("a"), F.col("z")),
        vx.l1(F.col("a"), F.col("z")), vx.normalise(F.col("a")), vx.normalise(F.col("z")), vx.shorten(F.col("a"), 1),
    ).first()
    assert tuple(row) == (5.0, None, 5.0, 7.0, [0.6, 0.8], None, [1.0])


def test_vector_check(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, None), (6, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "k int, v array<float>")
    assert {r["k"] for r in embed.vector_report(df, "k", "v", 2).collect() if r["ok"]} == {1}


def test_user_model_shape_is_checked(spark):
    df = spark.createDataFrame([("a",)], "t string")
    model = embed.FunctionModel("bad", 3, lambda: lambda texts: np.zeros((len(texts), 2)))
    with pytest.raises(Exception, match="model returned"):
        embed.embed(df, "t", model).collect()


def test_filters(spark):
    rows = [(1, "a/b.pdf x", 5), (2, None, 7), (3, "other", None)]
    df = spark.createDataFrame(rows, "k int, path string, page int")

    def keys(filters):
        return {r["k"] for r in df.filter(flt.predicate(filters, df.columns)).collect()}

    assert keys({"path LIKE": "a/b.pdf"}) == {1}
    assert keys({"path like": "b.pdf"}) == set()
    assert keys({"path CONTAINS": "b.pdf"}) == {1}
    assert keys({"path NOT": "other"}) == {1, 2}
    assert keys({"path NOT": ["other", "x"]}) == {1, 2}
    assert keys({"page >": 4, "page <": 7}) == {1}
    assert keys({"page >=": 5, "page <=": 7}) == {1, 2}
    assert keys({"k": [1, 3]}) == {1, 3}
    assert flt.predicate({}, df.columns) is None
    for bad in ({"nope": 1}, {"path ~": 1}):
        with pytest.raises(ValueError):
            flt.predicate(bad, df.columns)


def test_fusion(spark):
    schema = "query_id int, key int, score double, rank int"
    a = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2)], schema)
    b = spark.createDataFrame([(1, 11, 5.0, 1), (1, 12, 4.0, 2)], schema)
    got = [(r["key"], r["score"]) for r in rank.fuse(a, b, 3).orderBy("rank").collect()]
    assert got == [(11, round(1 / 62 + 1 / 61, 6)), (10, round(1 / 61, 6)), (12, round(1 / 62, 6))]


def test_coverage_reranker(spark):
    df = spark.createDataFrame([("red fox", "a red, FOX ran"), ("red fox", "fox red"), ("", "x")], "query_text string, t string")
    got = [r["score"] for r in rank.CoverageReranker(("t",)).score(df).collect()]
    assert got == [1.0, 0.5, 0.0]


def test_latest_per_key_on_one_hot_key(spark):
    rows = [(1, i, f"v{i}") for i in range(1000)] + [(2, 5, "w")]
    df = spark.createDataFrame(rows, "k int, seq int, v string").repartition(6)
    assert {tuple(r) for r in changes.latest_per_key(df, "k", ["seq"]).collect()} == {(1, 999, "v999"), (2, 5, "w")}


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def index(spark, docs):
    from docsift.session import scratch_database

    return ix.create_index(
        docs, f"{scratch_database(spark)}.search_test", "doc_id", text_col="text", model=embed.HashedModel(), filter_columns=["lang"], n_cells=8
    )


def test_single_text_search(index, docs):
    text = docs.orderBy("doc_id").first()["text"]
    for mode in (None, "similarity", "HYBRID", "full_text"):
        hits = se.similarity_search(index, text, ["lang", "text"], 3, mode, fusion_depth=50).orderBy("rank").collect()
        assert [h["rank"] for h in hits] == [1, 2, 3]
        assert hits[0]["text"] == text
        assert set(hits[0].asDict()) == {"rank", "score", "doc_id", "lang", "text"}
    with pytest.raises(ValueError):
        se.similarity_search(index, text, ["lang"], 3, "magic")
    with pytest.raises(ValueError, match="fusion_depth"):
        se.similarity_search(index, text, ["lang"], 3, "hybrid")
    with pytest.raises(ValueError):
        se.similarity_search(index, text, ["nope"], 3).collect()
    with pytest.raises(ValueError):
        se.similarity_search(index, text, ["lang"], 3, filters={"nope": 1})
    found = se.similarity_search(index, text, ["lang"], 10_000, filters={"lang": "fr"})
    assert found.count() == docs.filter("lang = 'fr'").count()


def test_reranked_search_is_a_reordering(index, docs):
    text = docs.orderBy("doc_id").first()["text"]
    top = {r["doc_id"] for r in se.similarity_search(index, text, [], 20).collect()}
    again = se.similarity_search(
        index, text, ["lang"], 20, reranker=rank.CoverageReranker(("text",)), candidates=20
    ).collect()
    assert {r["doc_id"] for r in again} == top


def test_model_is_checked(spark, index):
    with pytest.raises(ValueError, match="built with model"):
        ix.get_index(spark, index.name, embed.HashedModel(32))
    opened = ix.get_index(spark, index.name)
    assert opened.model == embed.HashedModel(64) and opened.info == index.info
    assert np.allclose(opened.centres, index.centres)


def test_bad_sources_are_refused(spark, docs, index_name):
    with pytest.raises(ValueError, match="not a primary key"):
        ix.create_index(docs, index_name, "source", text_col="text")
    with pytest.raises(ValueError, match="must be a string"):
        ix.create_index(docs, index_name, "doc_id", text_col="n_chars")
    with pytest.raises(ValueError, match="lacks columns"):
        ix.create_index(docs, index_name, "doc_id", text_col="nope")
    assert not ix.index_exists(spark, index_name)


def test_approximate_search_reads_probed_cells_only(index, docs):
    text = docs.orderBy("doc_id").first()["text"]
    all_cells = se.similarity_search(index, text, [], 5, nprobe=10_000).collect()
    exact = se.similarity_search(index, text, [], 5).collect()
    assert all_cells == exact
    plan = se.similarity_search(index, text, [], 5, nprobe=2)._jdf.queryExecution().executedPlan().toString()
    assert "cell" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_keyword_search_does_not_shuffle_postings(index, docs):
    text = docs.orderBy("doc_id").first()["text"]
    plan = se.similarity_search(index, text, [], 5, "full_text")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Bucketed: true" in below and "Exchange hashpartitioning" not in below


def test_hits_are_fetched_from_their_shards(spark, docs, index_name, monkeypatch):
    monkeypatch.setattr(ix, "ROWS_PER_SHARD", 20)
    index = ix.create_index(docs, index_name, "doc_id", text_col="text")
    assert index.info["n_shards"] > 5
    text = docs.orderBy("doc_id").first()["text"]
    found = se.similarity_search(index, text, ["text"], 2, "full_text")
    assert found.orderBy("rank").first()["text"] == text
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [part.split("PushedFilters")[0] for part in plan.split("PartitionFilters")[1:]]
    assert any("_shard" in scan for scan in scans)
    assert ix.drop_index(spark, index_name) and not ix.index_exists(spark, index_name)


def test_self_managed_vectors(spark, sf, index_name):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    index = ix.create_index(e, index_name, "vec_id", vector_col="embedding")
    one = e.filter("vec_id = 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    hit = se.search(index, one, se.SearchSpec(("label",), 1)).first()
    assert (hit["vec_id"], hit["score"]) == (3, 1.0)
    with pytest.raises(ValueError, match="no text model"):
        se.similarity_search(index, "text", [], 1)


VECTORS = "key long, vector array<double>"
ASKED = "query_id long, vector array<double>"


def hits_of(spark, rows, asked, k=3, metric="cosine", schema=VECTORS):
    found = topk.nearest(spark.createDataFrame(rows, schema), spark.createDataFrame(asked, ASKED), k, metric)
    return [(r["query_id"], r["key"], r["score"]) for r in found.orderBy("query_id", "rank").collect()]


def test_a_null_vector_shifts_no_key(spark):
    rows = [(10, [1.0, 0.0]), (11, None), (12, [0.0, 1.0])]
    assert hits_of(spark, rows, [(0, [0.0, 1.0]), (1, None)]) == [(0, 12, 1.0), (0, 10, 0.0)]


def test_another_dimension_is_an_error(spark):
    with pytest.raises(Exception, match="among vectors of 2"):
        hits_of(spark, [(1, [1.0, 2.0, 3.0, 4.0])], [(0, [1.0, 2.0])])


def test_l2_of_close_vectors_far_from_the_origin(spark):
    a = [8000.0, 1.0]
    rows = [(1, a), (2, [8000.0, 1.00008]), (3, [8000.0, 1.5])]
    assert hits_of(spark, rows, [(0, a)], metric="l2") == [(0, 1, 0.0), (0, 2, 8e-5), (0, 3, 0.5)]


def test_key_types_without_a_shared_order_are_refused(spark):
    import datetime

    with pytest.raises(ValueError, match="whole number or a string"):
        hits_of(spark, [(datetime.date(2024, 1, 1), [1.0])], [(0, [1.0])], schema="key date, vector array<double>")


def test_repeated_query_ids_are_refused(spark):
    with pytest.raises(ValueError, match="tell queries apart"):
        hits_of(spark, [(1, [1.0])], [(0, [1.0]), (0, [2.0])])


def test_many_queries_are_worked_off_in_blocks(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], VECTORS)
    asked = spark.createDataFrame([(i, [float(i % 20), 1.0]) for i in range(60)], ASKED)
    found = topk.nearest(rows, asked, 1, "l2", batch_queries=7).collect()
    assert {r["query_id"]: r["key"] for r in found} == {i: i % 20 for i in range(60)}


def test_cells_follow_the_metric(spark):
    """Long and short vectors of one direction lie in different cells of an L2 index."""

    rows = spark.createDataFrame([(i, [1.0 + i % 2 * 99, 0.001 * i]) for i in range(40)] + [(99, [0.0, 0.0])], VECTORS)
    centres = cells.train_cells(rows, "vector", 2, "l2")
    placed = rows.select("key", cells.cell_of(F.col("vector"), centres, "l2").alias("cell")).collect()
    cell = {r["key"]: r["cell"] for r in placed}
    assert cells.NO_CELL not in cell.values()
    assert len({cell[i] for i in range(0, 40, 2)}) == 1 and cell[0] != cell[1] and cell[99] == cell[0]


def test_nprobe_needs_cells_and_the_dimension_is_checked(spark, index_name):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "k int, v array<double>")
    index = ix.create_index(rows, index_name, "k", vector_col="v")
    ask = lambda v: spark.createDataFrame([(0, v)], ASKED)
    with pytest.raises(ValueError, match="cells"):
        se.search(index, ask([1.0, 2.0]), se.SearchSpec((), 3, nprobe=2))
    with pytest.raises(ValueError, match="has not 2 numbers"):
        se.search(index, ask([1.0]), se.SearchSpec((), 3))
    with pytest.raises(ValueError, match="unknown metric"):
        ix.create_index(rows, index_name + "_m", "k", vector_col="v", metric="dot")


def test_many_queries_are_dealt_to_cells(spark, monkeypatch):
    """Hot cells in slices, their queries in chunks; equal to a scan, for 20,000 queries and all metrics."""
    monkeypatch.setattr(topk, "SLICE_VALUES", 100)
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 700)
    rng = np.random.default_rng(8)
    points = rng.integers(-2, 3, size=(300, 4)).astype(float).tolist() + [None]
    v = spark.createDataFrame([(i, p, 0 if i % 3 else i % 5) for i, p in enumerate(points)], "key bigint, vector array<float>, cell int")
    asked = rng.integers(-2, 3, size=(20_000, 4)).astype(float).tolist()
    q = spark.createDataFrame([(i, p, [0, 1, 2, 3, 4][: 1 + i % 5]) for i, p in enumerate(asked)], "query_id bigint, vector array<float>, probes array<int>")
    few = q.filter("query_id % 100 < 7")
    jobs = []
    monkeypatch.setattr(topk, "in_batches", lambda *a, **b: jobs.append(1))
    full = 3 * sum(any(p) for p in asked)  # a zero query has no cosine
    assert topk.nearest(v, q, 3).count() == full and topk.nearest(v, q, 3, within="cells").count() == full and not jobs
    monkeypatch.undo()
    for metric in ("cosine", "l2", "l1"):
        for within in (None, "cells"):
            want = topk.nearest(v, few, 3, metric, within=within).select("query_id", "rank", "key", "score")
            got = topk.spread(v.filter("vector IS NOT NULL"), few, 3, metric, within).select(want.columns)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    none = topk.spread(v.filter("key < 0"), few, 3)
    assert none.count() == 0 and topk.spread(v.filter("key = 1"), few.limit(0), 3).count() == 0


def brute_phrase(docs, asked):
    out = []
    for q, a in asked.items():
        want = a.lower().split()
        for key, text in docs.items():
            held = (text or "").lower().split()
            at = [i for i in range(len(held) - len(want) + 1) if held[i : i + len(want)] == want] if want else []
            if at:
                out.append((q, key, len(at), at[0]))
    return sorted(out)


def test_phrases_by_positions(spark, index_name):
    rng = np.random.default_rng(5)
    docs = {i: " ".join(rng.choice(list("abcd"), size=rng.integers(0, 60))) for i in range(150)}
    docs |= {500: None, 501: "x " * 3000 + "y z y z y", 502: ""}
    asked = {i: " ".join(rng.choice(list("abcd"), size=rng.integers(1, 5))) for i in range(30)}
    asked |= {40: "y z y", 41: "", 42: "nowhere a", 43: "x x x", 44: "z x", 45: "A b"}
    rows = spark.createDataFrame(list(docs.items()), "k bigint, text string").withColumn("part", F.col("k") % 3)
    queries = spark.createDataFrame(list(asked.items()), "query_id bigint, query_text string")
    index = ix.create_index(rows, index_name, "k", text_col="text", filter_columns=["part"], positions=True)
    found = se.match_phrase(index, queries)
    assert sorted(map(tuple, found.collect())) == brute_phrase(docs, asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "__rows" not in plan and "text#" not in plan.replace("query_text#", "")
    some = se.match_phrase(index, queries, filters={"part": 1})
    assert sorted(map(tuple, some.collect())) == brute_phrase({k: t for k, t in docs.items() if k % 3 == 1}, asked)
    lists = index.live("postings").select("key", "term", "tf", lexical.places(F.col("positions")).alias("at")).collect()
    for r in lists:
        held = (docs[r["key"]] or "").split()
        assert [i for i, t in enumerate(held) if t == r["term"]] == r["at"] and len(r["at"]) == r["tf"]
    later = rows.filter("k <> 501").unionByName(spark.createDataFrame([(900, "b y z y c", 0)], "k bigint, text string, part bigint"))
    ix.sync(index, later)
    docs = {k: t for k, t in docs.items() if k != 501} | {900: "b y z y c"}
    assert sorted(map(tuple, se.match_phrase(index, queries).collect())) == brute_phrase(docs, asked)
    plain = ix.create_index(rows, index_name + "_plain", "k", text_col="text")
    with pytest.raises(ValueError, match="positions"):
        se.match_phrase(plain, queries)


def test_late_interaction(spark):
    model = embed.HashedTokenModel(16)
    texts = ["red fox", "", None, "foxes redder red", "x", "red " * 50 + "word" + " ".join(f"w{i}" for i in range(300))]
    pairs = [(i, q, t) for i, (q, t) in enumerate((q, t) for q in ("red foxes red", "", "unknown") for t in texts)]
    df = spark.createDataFrame(pairs, "key int, query_text string, text string")

    def brute(q, t):
        a, b = model.vectors((q or "").split()), model.vectors((t or "").split())
        return round(float((a @ b.T).max(axis=1).sum()), 6) if len(a) and len(b) else 0.0

    want = {i: pytest.approx(brute(q, t), abs=1e-6) for i, q, t in pairs}
    for size in (1 << 24, 16 * 8 * 20, 1):  # one group, several, and each passage in parts
        scored = rank.LateInteractionReranker(("text",), model, size).score(df)
        assert {r["key"]: r["score"] for r in scored.collect()} == want
    near, far = model.vectors(["foxes", "fox"]) @ model.vectors(["fox"]).T
    assert far == pytest.approx(1.0) and 0.3 < near < 1.0


def test_size_quality_of_several_sizes(spark):
    """Small chunks find a short passage in a long text; counts are those of the cuts."""
    from docsift.plans import study

    model = embed.HashedModel(32)
    filler = " ".join(f"filler{i % 40}" for i in range(400))
    docs = [(i, f"{filler} topic{i} detail{i} {filler}") for i in range(6)] + [(10, None), (11, ""), (12, "short")]
    df = spark.createDataFrame(docs, "k int, text string")
    queries = spark.createDataFrame([(i, f"topic{i} detail{i}") for i in range(6)] + [(9, "nothing")], "query_id bigint, query_text string")
    relevant = spark.createDataFrame([(i, i) for i in range(6)], "query_id bigint, key int")
    sizes = [(40, 10), (100_000, 0)]
    got = {r["size"]: r for r in study.size_quality(df, "k", "text", queries, relevant, model, sizes, k=2).collect()}
    cut = {s: chunk.fixed_chars(df, ["k"], "text", s, o).count() for s, o in sizes}
    assert {s: r["n_chunks"] for s, r in got.items()} == cut and {r["n_queries"] for r in got.values()} == {6}
    asked = {r["query_id"]: np.array(r["v"]) for r in queries.select("query_id", model.column(F.col("query_text")).alias("v")).collect()}
    for size, overlap in sizes:
        cut_rows = chunk.fixed_chars(df, ["k"], "text", size, overlap).select("k", "pos", model.column(F.col("chunk")).alias("v")).collect()
        shares = []
        for q in range(6):
            scored = []
            for r in cut_rows:
                v = np.array(r["v"])
                length = np.linalg.norm(v) * np.linalg.norm(asked[q])
                if length > 0:
                    scored.append((-round(float(v @ asked[q] / length), 6), f"{r['k']}#{r['pos']}", r["k"] == q))
            shares.append(np.mean([x[2] for x in sorted(scored)[:2]]))
        assert got[size]["hit_rate"] == pytest.approx(np.mean([x > 0 for x in shares]), abs=1e-6)
        assert got[size]["precision"] == pytest.approx(np.mean(shares), abs=1e-6)
    none = study.size_quality(df, "k", "text", queries, relevant.limit(0), model, sizes).collect()
    assert {(r["n_queries"], r["hit_rate"]) for r in none} == {(0, None)}


def test_many_phrase_candidates_leave_the_postings_in_their_buckets(spark, index_name, monkeypatch):
    docs = {i: f"a b {'c' if i % 2 else 'a b'} d{i}" for i in range(60)}
    asked = {1: "a b", 2: "b c", 3: "b a b", 4: "a b a b"}
    rows = spark.createDataFrame(list(docs.items()), "k bigint, text string")
    index = ix.create_index(rows, index_name, "k", text_col="text", positions=True)
    monkeypatch.setattr(lexical, "small_side", lambda df, n: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = se.match_phrase(index, spark.createDataFrame(list(asked.items()), "query_id bigint, query_text string"))
        assert sorted(map(tuple, found.collect())) == brute_phrase(docs, asked)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"hashpartitioning\(key#\d+L?, term#", plan) and "Bucketed: true" in plan


def test_postings_come_in_runs_by_term(spark):
    texts = ["b a c a", None, "c c B", "", "ä z a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k bigint, text string").coalesce(1)
    got = [tuple(r)[:5] for r in lexical.postings(docs, "k", "text", positions=True).collect()]
    assert [r[1] for r in got] == ["a", "a", "b", "b", "b", "c", "c", "z", "ä"]
    assert sorted(got)[:3] == [(0, "a", 2, 4, [1, 2]), (0, "b", 1, 4, [0]), (0, "c", 1, 4, [2])]


def test_order_of_pairs_is_stable_however_large():
    few = np.array([5, 3, 5, 3, 0])
    for shift in (0, 58):
        order, pairs = lexical._ordered(few << shift)
        assert order.tolist() == [4, 1, 3, 0, 2] and (pairs == (few << shift)[order]).all()


def test_cells_are_fitted_to_a_bounded_sample(spark, index_name, monkeypatch):
    """Centres come from some rows, every row has a cell, and few cells hold the nearest rows."""
    monkeypatch.setattr(cells, "TRAIN_ROWS", 500)
    monkeypatch.setattr(cells, "TRAIN_ROWS_PER_CELL", 20)
    rng = np.random.default_rng(5)
    middles = rng.standard_normal((40, 16))
    points = middles[np.arange(6000) % 40] + 0.3 * rng.standard_normal((6000, 16))
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, v array<double>")
    fitted, fit = [], cells.train_cells

    def seen(vectors, *rest):
        fitted.append(vectors.count())
        return fit(vectors, *rest)

    monkeypatch.setattr(cells, "train_cells", seen)
    index = ix.create_index(rows, index_name, "id", vector_col="v", n_cells=30)
    assert 400 < fitted[0] < 800  # about 20 rows a cell of 6,000
    held = index.live("vectors")
    assert held.count() == 6000 and held.select("cell").distinct().count() > 20
    asking = rows.filter("id % 50 = 0").selectExpr("id AS query_id", "v AS vector")
    exact, found = (
        se.search(index, asking, se.SearchSpec((), 10, nprobe=n)).withColumnRenamed("id", "key") for n in (None, 6)
    )
    assert rank.recall(found, exact).agg(F.avg("recall")).first()[0] >= 0.9


def test_vectors_of_a_model_are_computed_once(spark):
    """A search over vectors that a model computes runs the model once a row; null vectors are no hits."""
    docs = spark.createDataFrame([(i, None if i % 3 == 0 else f"a b w{i}") for i in range(40)], "key bigint, text string")
    vectors = docs.select("key", F.when(F.col("text").isNotNull(), embed.HashedModel(16).column(F.col("text"))).alias("vector"))
    asked = spark.createDataFrame([(1, "a b w4")], "query_id bigint, text string").select("query_id", embed.HashedModel(16).column(F.col("text")).alias("vector"))
    found = topk.nearest(vectors, asked, 40)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    hits = found.collect()
    assert {r["key"] for r in hits} == {i for i in range(40) if i % 3} and min(hits, key=lambda r: r["rank"])["key"] == 4
    dealt = topk.nearest(vectors, asked.unionByName(asked.withColumn("query_id", F.lit(2).cast("bigint"))), 40, batch_queries=1)
    assert sorted(tuple(r) for r in dealt.filter("query_id = 1").select(*hits[0].__fields__).collect()) == sorted(map(tuple, hits))


def test_chunk_sizes_are_scored_as_cells(spark, monkeypatch):
    """All queries of a size meet its chunks at once; vectors are computed once."""
    from docsift.plans import study

    docs = spark.createDataFrame([(i, f"common words {i} " * 30 + ("the passage" if i == 7 else "")) for i in range(12)], "k bigint, t string")
    asked = spark.createDataFrame([(1, "the passage"), (2, "words 3"), (3, "nothing")], "query_id bigint, query_text string")
    relevant = spark.createDataFrame([(1, 7), (2, 3)], "query_id bigint, key bigint")
    seen, real = [], topk.nearest

    def noted(*args, **more):
        hits = real(*args, **more)
        seen.append((more["within"], hits._jdf.queryExecution().executedPlan().toString()))
        return hits

    monkeypatch.setattr(topk, "nearest", noted)
    rows = study.size_quality(docs, "k", "t", asked, relevant, embed.HashedModel(32), [(40, 10), (200, 40)], 2).orderBy("size").collect()
    assert [w for w, _ in seen] == ["cells"] and seen[0][1].count("ArrowEvalPython") == 1
    assert [(r["size"], r["n_queries"]) for r in rows] == [(40, 2), (200, 2)] and all(0 < r["hit_rate"] <= 1 for r in rows)
