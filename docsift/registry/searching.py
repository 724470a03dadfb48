"""Vector, keyword and hybrid search, filters, reranking and evaluation."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from docsift.functions import vectors as vx
from docsift.operators import cells, chunk, embed, lexical, rank, topk
from docsift.plans import filters as flt
from docsift.plans import search as se
from docsift.plans import study
from docsift.registry.base import PARTS, STORED, bucket, coverage, load, query, sign, toks, words
from docsift.registry.chunking import FIXED_SQL
from docsift.registry.indexing import documents_index, on_revised, once, revised_index, vectors_index
from docsift.session import scratch_database, written

MODEL = embed.HashedModel()


def asked(spark, sf):
    return load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def run(spark, sf, spec, *columns):
    found = se.search(documents_index(spark, sf), asked(spark, sf), spec)
    return found.select(*(columns or ("query_id", "rank", "score", "doc_id", *[c for c in spec.columns if c != "doc_id"])))


def centroids(spark, sf):
    """One query per label: the mean of its vectors."""
    points = load(spark, sf, "embeddings").select("label", array_to_vector("embedding").alias("v"))
    means = points.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select(F.col("label").alias("query_id"), vector_to_array("m").alias("vector"))


def stored_vectors(spark, sf):
    return load(spark, sf, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))


KNN_PARTS = """
    e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    c AS (SELECT label AS query_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    q AS (SELECT query_id, i, avg(x) AS x FROM c GROUP BY ALL)"""
METRIC_SQL = {
    "cosine": ("sum(q.x * e.x) / (sqrt(sum(q.x * q.x)) * sqrt(sum(e.x * e.x)))", "DESC"),
    "l2": ("sqrt(sum((q.x - e.x) * (q.x - e.x)))", "ASC"),
    "l1": ("sum(abs(q.x - e.x))", "ASC"),
}


def knn_sql(metric: str, k: int = 10) -> str:
    score, order = METRIC_SQL[metric]
    return f"""WITH {KNN_PARTS},
    s AS (SELECT query_id, vec_id AS key, round({score}, 6) AS score FROM q JOIN e USING (i) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, key) AS rank FROM s)
    SELECT query_id, key, score, rank FROM r WHERE rank <= {k}"""


def _knn(spark, sf, metric):
    found = topk.nearest(stored_vectors(spark, sf), centroids(spark, sf), 10, metric)
    return found.select("query_id", "key", "score", "rank")


@query("knn_cosine", knn_sql("cosine"))
def knn_cosine(spark, sf):
    return _knn(spark, sf, "cosine")


@query("knn_l2", knn_sql("l2"))
def knn_l2(spark, sf):
    return _knn(spark, sf, "l2")


@query("knn_l1", knn_sql("l1"))
def knn_l1(spark, sf):
    return _knn(spark, sf, "l1")


@query(
    "knn_null_vectors",
    knn_sql("cosine").replace("FROM q JOIN e USING (i)", "FROM q JOIN (SELECT * FROM e WHERE vec_id % 7 <> 0) e USING (i)"),
)
def knn_null_vectors(spark, sf):
    some = F.when(F.col("key") % 7 != 0, F.col("vector"))
    found = topk.nearest(stored_vectors(spark, sf).withColumn("vector", some), centroids(spark, sf), 10)
    return found.select("query_id", "key", "score", "rank")


@query(
    "pair_metrics",
    f"""WITH {KNN_PARTS}, own AS (SELECT vec_id, label AS query_id FROM embeddings)
    SELECT vec_id, round({METRIC_SQL['cosine'][0]}, 6) AS cosine, round({METRIC_SQL['l2'][0]}, 6) AS l2,
      round({METRIC_SQL['l1'][0]}, 6) AS l1
    FROM own JOIN q USING (query_id) JOIN e USING (vec_id, i) GROUP BY vec_id""",
)
def pair_metrics(spark, sf):
    means = centroids(spark, sf).withColumnRenamed("query_id", "label")
    a, b = F.col("embedding"), F.col("vector")
    return load(spark, sf, "embeddings").join(means, "label").select(
        "vec_id",
        *[F.round(f(a, b), 6).alias(n) for n, f in (("cosine", vx.cosine), ("l2", vx.l2), ("l1", vx.l1))],
    )


@query(
    "search_similarity",
    "SELECT query_id, rank, score, doc_id, source, text FROM {{sim_all}} JOIN documents USING (doc_id) WHERE rank <= 3",
)
def search_similarity(spark, sf):
    return run(spark, sf, se.SearchSpec(("source", "text"), 3))


@query(
    "search_fulltext",
    "SELECT query_id, rank, score, doc_id, source FROM {{key_all}} JOIN documents USING (doc_id) WHERE rank <= 5",
)
def search_fulltext(spark, sf):
    return run(spark, sf, se.SearchSpec(("source",), 5, "FULL_TEXT"))


@query(
    "search_hybrid",
    "SELECT query_id, rank, score, doc_id, source FROM {{fused_all}} JOIN documents USING (doc_id) WHERE rank <= 5",
)
def search_hybrid(spark, sf):
    return run(spark, sf, se.SearchSpec(("source",), 5, "hybrid", fusion_depth=50))


def _after_sync(spark, sf, spec):
    found = se.search(revised_index(spark, sf), asked(spark, sf), spec)
    return found.select("query_id", "rank", "score", "doc_id", "source")


@query(
    "similarity_after_sync",
    on_revised("SELECT query_id, rank, score, doc_id, source FROM {{sim_all}} JOIN documents USING (doc_id) WHERE rank <= 5"),
)
def similarity_after_sync(spark, sf):
    return _after_sync(spark, sf, se.SearchSpec(("source",), 5))


@query(
    "fulltext_after_sync",
    on_revised("SELECT query_id, rank, score, doc_id, source FROM {{key_all}} JOIN documents USING (doc_id) WHERE rank <= 5"),
)
def fulltext_after_sync(spark, sf):
    return _after_sync(spark, sf, se.SearchSpec(("source",), 5, "FULL_TEXT"))


PHRASE_SQL = f"""
    SELECT query_id, key, CAST(len(spots) AS INTEGER) AS n_places, CAST(list_min(spots) AS INTEGER) AS first_place FROM (
      SELECT query_id, key, list_filter(range(len(d) - len(q) + 1), lambda i: d[i + 1:i + len(q)] = q) AS spots FROM (
        SELECT item_id AS query_id, {toks('text')} AS q FROM benchmark) JOIN (
        SELECT doc_id AS key, {toks('text')} AS d FROM documents)
      ON len(q) > 0 AND contains(' ' || array_to_string(d, ' ') || ' ', ' ' || array_to_string(q, ' ') || ' '))"""


@query("phrase_by_positions", PHRASE_SQL)
def phrase_by_positions(spark, sf):
    return se.match_phrase(documents_index(spark, sf), asked(spark, sf))


@query("phrase_after_sync", on_revised(PHRASE_SQL))
def phrase_after_sync(spark, sf):
    return se.match_phrase(revised_index(spark, sf), asked(spark, sf))


@query(
    "search_all_terms",
    """SELECT query_id, doc_id AS key, CAST(n AS INTEGER) AS n_terms FROM (
      SELECT query_id, doc_id, count(*) AS m FROM {{qterm}} JOIN {{post}} USING (term) GROUP BY ALL)
    JOIN (SELECT query_id, count(*) AS n FROM {{qterm}} GROUP BY query_id) USING (query_id) WHERE m = n""",
)
def search_all_terms(spark, sf):
    return se.match_all_terms(documents_index(spark, sf), asked(spark, sf))


@query(
    "all_terms_filtered",
    """SELECT query_id, doc_id AS key, CAST(n AS INTEGER) AS n_terms FROM (
      SELECT query_id, doc_id, count(*) AS m FROM {{qterm}} JOIN {{post}} USING (term) GROUP BY ALL)
    JOIN (SELECT query_id, count(*) AS n FROM {{qterm}} GROUP BY query_id) USING (query_id)
    JOIN documents USING (doc_id) WHERE m = n AND lang = 'en'""",
)
def all_terms_filtered(spark, sf):
    return se.match_all_terms(documents_index(spark, sf), asked(spark, sf), filters={"lang": "en"})


@query("filter_like", "SELECT doc_id, source FROM documents WHERE list_contains(string_split_regex(text, '\\s+'), 'the')")
def filter_like(spark, sf):
    docs = load(spark, sf, "documents")
    return docs.filter(flt.predicate({"text LIKE": "the"}, docs.columns)).select("doc_id", "source")


@query("filter_not", "SELECT doc_id, lang FROM documents WHERE lang IS DISTINCT FROM 'en'")
def filter_not(spark, sf):
    docs = load(spark, sf, "documents")
    return docs.filter(flt.predicate({"lang NOT": "en"}, docs.columns)).select("doc_id", "lang")


@query("filter_range", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 500 AND n_chars < 5000")
def filter_range(spark, sf):
    docs = load(spark, sf, "documents")
    return docs.filter(flt.predicate({"n_chars >": 500, "n_chars <": 5000}, docs.columns)).select("doc_id", "n_chars")


@query("filter_equal", "SELECT doc_id, lang, source FROM documents WHERE lang = 'fr' AND source IN ('src1', 'src2', 'src3')")
def filter_equal(spark, sf):
    docs = load(spark, sf, "documents")
    wanted = {"lang": "fr", "source": ["src1", "src2", "src3"]}
    return docs.filter(flt.predicate(wanted, docs.columns)).select("doc_id", "lang", "source")


def _among(condition: str, scored: str, k: int, columns: str) -> str:
    return f"""SELECT query_id, rank, score, doc_id, {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
      FROM {{{{{scored}}}}} JOIN documents USING (doc_id) WHERE {condition}) WHERE rank <= {k}"""


@query("prefilter_topk", _among("lang = 'en' AND n_chars > 500", "cosines", 3, "lang, n_chars"))
def prefilter_topk(spark, sf):
    return run(spark, sf, se.SearchSpec(("lang", "n_chars"), 3, filters={"lang": "en", "n_chars >": 500}))


@query("prefilter_by_key", _among("list_contains(string_split_regex(text, '\\s+'), 'the')", "cosines", 3, "lang"))
def prefilter_by_key(spark, sf):
    return run(spark, sf, se.SearchSpec(("lang",), 3, filters={"text LIKE": "the"}))


@query("fulltext_filtered", _among("lang IS DISTINCT FROM 'en'", "bm25", 5, "lang"))
def fulltext_filtered(spark, sf):
    return run(spark, sf, se.SearchSpec(("lang",), 5, "full_text", filters={"lang NOT": "en"}))


@query(
    "hybrid_filtered",
    """SELECT query_id, rank, score, doc_id, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
        SELECT query_id, doc_id,
          round(coalesce(1.0 / (60 + a.rank), 0) + coalesce(1.0 / (60 + b.rank), 0), 6) AS score
        FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
              FROM {{cosines}} WHERE doc_id IN (SELECT doc_id FROM documents WHERE n_chars >= 1000)) WHERE rank <= 50) a
        FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
              FROM {{bm25}} WHERE doc_id IN (SELECT doc_id FROM documents WHERE n_chars >= 1000)) WHERE rank <= 50) b
        USING (query_id, doc_id)))
    JOIN documents USING (doc_id) WHERE rank <= 5""",
)
def hybrid_filtered(spark, sf):
    return run(spark, sf, se.SearchSpec(("n_chars",), 5, "hybrid", fusion_depth=50, filters={"n_chars >=": 1000}))


def _reranked(first: str, k: int) -> str:
    return f"""SELECT query_id, rank, score, doc_id, source FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
        SELECT query_id, doc_id, source, {coverage('qt', 'dt')} AS score
        FROM (SELECT query_id, doc_id FROM {{{{{first}}}}} WHERE rank <= 50)
        JOIN (SELECT item_id AS query_id, {toks('text')} AS qt FROM benchmark) USING (query_id)
        JOIN (SELECT doc_id, source, {toks('text')} AS dt FROM documents) USING (doc_id)))
    WHERE rank <= {k}"""


COVERAGE = rank.CoverageReranker(("text",))


@query("rerank_coverage", _reranked("sim_all", 5))
def rerank_coverage(spark, sf):
    return run(spark, sf, se.SearchSpec(("source",), 5, reranker=COVERAGE))


@query("hybrid_reranked", _reranked("fused_all", 5))
def hybrid_reranked(spark, sf):
    return run(spark, sf, se.SearchSpec(("source",), 5, "hybrid", fusion_depth=50, reranker=COVERAGE))


@query(
    "rerank_user_fn",
    f"""SELECT query_id, rank, score, doc_id, source FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
        SELECT query_id, doc_id, d.source, round(len(list_intersect(list_distinct({words('b.text')}), {words('d.text')}))
          / (1.0 + abs(length(d.text) - length(b.text))), 6) AS score
        FROM {{{{sim50}}}} JOIN (SELECT item_id AS query_id, text FROM benchmark) b USING (query_id)
        JOIN documents d USING (doc_id)))
    WHERE rank <= 5""",
)
def rerank_user_fn(spark, sf):
    def load_model():
        import numpy as np

        def score(queries, texts):
            return np.array([len(set(q.split()) & set(t.split())) / (1 + abs(len(t) - len(q))) for q, t in zip(queries, texts)])

        return score

    return run(spark, sf, se.SearchSpec(("source",), 5, reranker=rank.FunctionReranker(("text",), load_model)))


STORED.update({"judged", "och", "ocv", "near", "nearq", "neard", "letters", "unit", "asks", "alike"})
TRIPLES = "list_transform(range(1, length(term) + 1), lambda i: substr(' ' || term || ' ', i, 3))"
PARTS.update(
    {
        "near": f"""
        SELECT query_id, doc_id, qt, dt FROM (SELECT query_id, doc_id FROM {{{{key50}}}} WHERE rank <= 10)
        JOIN (SELECT item_id AS query_id, {toks('text')} AS qt FROM benchmark) USING (query_id)
        JOIN (SELECT doc_id, {toks('text')} AS dt FROM documents) USING (doc_id)""",
        "nearq": "SELECT query_id, doc_id, unnest(qt) AS q FROM {{near}}",
        "neard": "SELECT DISTINCT query_id, doc_id, unnest(dt) AS d FROM {{near}}",
        "letters": f"""
        SELECT term, {bucket('t')} AS b, sum({sign('t')})::DOUBLE AS c
        FROM (SELECT term, unnest({TRIPLES}) AS t FROM (SELECT q AS term FROM {{{{nearq}}}} UNION SELECT d FROM {{{{neard}}}})) GROUP BY ALL""",
        "dense": """
        SELECT term, list(coalesce(c, 0) ORDER BY b) AS v, sqrt(sum(coalesce(c * c, 0))) AS len
        FROM (SELECT DISTINCT term FROM {{letters}}) CROSS JOIN range(64) r(b) LEFT JOIN {{letters}} USING (term, b) GROUP BY term""",
        "unit": "SELECT term, list_transform(v, lambda x: CASE WHEN len > 0 THEN x / len ELSE 0.0 END) AS v FROM {{dense}}",
        "asks": "SELECT DISTINCT * FROM {{nearq}}",
        "alike": """
        SELECT q, d, list_dot_product(x.v, y.v) AS s
        FROM (SELECT DISTINCT q, d FROM {{asks}} JOIN {{neard}} USING (query_id, doc_id))
        JOIN {{unit}} x ON x.term = q JOIN {{unit}} y ON y.term = d""",
        "matches": """
        SELECT query_id, doc_id, q, max(s) AS s
        FROM {{asks}} JOIN {{neard}} USING (query_id, doc_id) JOIN {{alike}} USING (q, d) GROUP BY ALL""",
        "interaction": """
        SELECT query_id, doc_id, round(sum(s), 6) AS score FROM {{nearq}} JOIN {{matches}} USING (query_id, doc_id, q) GROUP BY ALL""",
    }
)


@query(
    "rerank_late_interaction",
    """SELECT query_id, rank, score, doc_id, source FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM {{interaction}}
      JOIN documents USING (doc_id)) WHERE rank <= 5""",
)
def rerank_late_interaction(spark, sf):
    """The ten best by keywords, sorted by how well each token of the query is matched."""
    spec = se.SearchSpec(("source",), 5, "FULL_TEXT", reranker=rank.LateInteractionReranker(("text",)), candidates=10)
    return run(spark, sf, spec)


SHIFT_SQL = f"""SELECT query_id, doc_id AS key, CAST(a.rank AS INTEGER) AS rank_before, CAST(b.rank AS INTEGER) AS rank_after,
      CAST(a.rank - b.rank AS INTEGER) AS shift
    FROM (SELECT query_id, doc_id, rank FROM {{{{fused_all}}}} WHERE rank <= 5) a
    FULL JOIN ({_reranked('fused_all', 5)}) b USING (query_id, doc_id)"""


def _before_after(spark, sf):
    before = se.SearchSpec((), 5, "hybrid", fusion_depth=50)
    after = se.SearchSpec((), 5, "hybrid", fusion_depth=50, reranker=COVERAGE)
    index = documents_index(spark, sf)
    lists = [se.search(index, asked(spark, sf), spec).withColumnRenamed("doc_id", "key") for spec in (before, after)]
    return lists[0], lists[1]


@query("rank_shift", SHIFT_SQL)
def rank_shift(spark, sf):
    return rank.rank_shift(*_before_after(spark, sf))


@query(
    "overlap_at_k",
    f"""SELECT query_id, round(count(rank_before + rank_after) / 5.0, 6) AS overlap FROM ({SHIFT_SQL}) GROUP BY query_id""",
)
def overlap_at_k(spark, sf):
    return rank.overlap_at_k(*_before_after(spark, sf), 5)


PARTS.update(
    {
        "ch": f"SELECT *, doc_id || '#' || pos AS key FROM ({FIXED_SQL})",
        "ct": f"SELECT key, unnest({toks('chunk')}) AS term FROM {{{{ch}}}}",
        "cv": f"SELECT key, {bucket('term')} AS b, sum({sign('term')})::DOUBLE AS c FROM {{{{ct}}}} GROUP BY ALL",
        "cn": "SELECT key, sqrt(sum(c * c)) AS len FROM {{cv}} GROUP BY key HAVING sum(c * c) > 0",
    }
)


@query(
    "parent_retrieval",
    f"""SELECT query_id, key, score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS rank FROM (
        SELECT query_id, doc_id AS key, max(score) AS score FROM (
          SELECT query_id, key, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS r FROM (
            SELECT q.query_id, n.key, round(coalesce(d.dot, 0) / (q.len * n.len), 6) AS score
            FROM {{{{qnorm}}}} q CROSS JOIN {{{{cn}}}} n LEFT JOIN (
              SELECT query_id, key, sum(a.c * b.c) AS dot FROM {{{{qvec}}}} a JOIN {{{{cv}}}} b USING (b) GROUP BY ALL) d
            USING (query_id, key)))
        JOIN {{{{ch}}}} USING (key) WHERE r <= 50 GROUP BY query_id, doc_id))
    WHERE rank <= 5""",
)
def parent_retrieval(spark, sf):
    pieces = chunk.fixed_chars(load(spark, sf, "documents").select("doc_id", "text"), ["doc_id"], "text", 1000, 200)
    keyed = pieces.withColumn("key", F.concat_ws("#", "doc_id", "pos"))
    vectors = keyed.select("key", MODEL.column(F.col("chunk")).alias("vector"))
    queries = asked(spark, sf).select("query_id", MODEL.column(F.col("query_text")).alias("vector"))
    hits = topk.nearest(vectors, queries, 50)
    # The key holds its parent, so no look-up of owners is needed.
    owners = hits.select("key").distinct().withColumn("parent", F.split_part("key", F.lit("#"), F.lit(1)).cast("bigint"))
    return se.parents(hits, owners, 5)


OPTIONS = [(250, 50), (500, 100), (1000, 200), (2000, 400)]
PARTS.update(
    {
        "opt": f"SELECT * FROM (VALUES {', '.join(map(str, OPTIONS))}) v(size, overlap)",
        "och": """
        SELECT size, overlap, doc_id, i AS pos, substr(text, i * (size - overlap) + 1, size) AS chunk FROM (
          SELECT size, overlap, doc_id, text, unnest(range(1 + CAST(greatest(0, ceil((length(text) - size) / CAST(size - overlap AS DOUBLE))) AS BIGINT))) AS i
          FROM documents, {{opt}} WHERE length(text) > 0)""",
        "ocv": f"""
        SELECT size, doc_id, pos, {bucket('term')} AS b, sum({sign('term')})::DOUBLE AS c
        FROM (SELECT size, doc_id, pos, unnest({toks('chunk')}) AS term FROM {{{{och}}}}) GROUP BY ALL""",
        "ocn": "SELECT size, doc_id, pos, sqrt(sum(c * c)) AS len FROM {{ocv}} GROUP BY ALL HAVING sum(c * c) > 0",
        "judged": f"""
        SELECT item_id AS query_id, doc_id FROM (SELECT item_id, {toks('text')} AS q FROM benchmark)
        JOIN (SELECT doc_id, {toks('text')} AS d FROM documents)
        ON len(q) > 0 AND contains(' ' || array_to_string(d, ' ') || ' ', ' ' || array_to_string(q, ' ') || ' ')""",
        "osim": """
        SELECT q.query_id, n.size, n.doc_id, n.pos, round(coalesce(x.dot, 0) / (q.len * n.len), 6) AS score
        FROM (SELECT * FROM {{qnorm}} WHERE query_id IN (SELECT query_id FROM {{judged}})) q CROSS JOIN {{ocn}} n
        LEFT JOIN (SELECT query_id, size, doc_id, pos, sum(a.c * b.c) AS dot FROM {{qvec}} a JOIN {{ocv}} b USING (b) GROUP BY ALL) x
        USING (query_id, size, doc_id, pos)""",
        "ohit": """
        SELECT query_id, size, max(good) AS hit, avg(good) AS share FROM (
          SELECT query_id, size, CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END AS good FROM (
            SELECT * FROM {{osim}} QUALIFY row_number() OVER (PARTITION BY query_id, size ORDER BY score DESC, doc_id || '#' || pos) <= 5)
          LEFT JOIN {{judged}} j USING (query_id, doc_id)) GROUP BY ALL""",
    }
)


@query(
    "chunk_size_quality",
    """SELECT size, overlap, n_chunks, mean_chars, n_queries, round(coalesce(hits, 0) / n_queries, 6) AS hit_rate,
      round(coalesce(shares, 0) / n_queries, 6) AS precision
    FROM (SELECT size, overlap, count(*) AS n_chunks, round(avg(length(chunk)), 6) AS mean_chars FROM {{och}} GROUP BY ALL)
    LEFT JOIN (SELECT size, sum(hit) AS hits, sum(share) AS shares FROM {{ohit}} GROUP BY size) USING (size),
      (SELECT count(DISTINCT query_id) AS n_queries FROM {{judged}})""",
)
def chunk_size_quality(spark, sf):
    """How often the first five chunks lead to a document that holds the passage, for four chunk sizes."""
    relevant = se.match_phrase(documents_index(spark, sf), asked(spark, sf)).select("query_id", "key")
    return study.size_quality(load(spark, sf, "documents"), "doc_id", "text", asked(spark, sf), relevant, MODEL, OPTIONS)


@query(
    "phrase_match",
    f"""SELECT doc_id, source FROM documents WHERE contains(' ' || array_to_string({toks('text')}, ' ') || ' ', ' of the ')""",
)
def phrase_match(spark, sf):
    docs = load(spark, sf, "documents")
    return docs.filter(lexical.phrase(F.col("text"), F.lit("Of the"))).select("doc_id", "source")


def purchases(spark, sf, n_users):
    """A purchase grants its user one source; the callers are the busiest users."""
    events = load(spark, sf, "events")
    callers = events.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").limit(n_users).select("user_id")
    number = F.get_json_object("props", "$.k").cast("int") % 20
    bought = events.filter("event_type = 'purchase'").join(callers, "user_id", "left_semi")
    return bought.select("user_id", F.concat(F.lit("src"), number.cast("string")).alias("source")).distinct()


@query(
    "grants_by_user",
    """SELECT asked AS query_id, rank, score, doc_id, source FROM (
      SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, doc_id) AS rank FROM (
        SELECT *, 1000 * query_id + user_id AS asked FROM {{cosines}} JOIN documents USING (doc_id) JOIN (
          SELECT DISTINCT user_id, 'src' || CAST(CAST(props->>'$.k' AS INTEGER) % 20 AS VARCHAR) AS source
          FROM events WHERE event_type = 'purchase' AND user_id IN (
            SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 2)) USING (source)))
    WHERE rank <= 3""",
)
def grants_by_user(spark, sf):
    grants = purchases(spark, sf, 2).withColumnRenamed("user_id", "caller")
    callers = grants.select("caller").distinct()
    # Both users ask all questions.
    both = callers.agg(F.collect_list("caller").alias("callers"))
    queries = asked(spark, sf).join(F.broadcast(both)).withColumn("caller", F.explode("callers"))
    queries = queries.withColumn("query_id", 1000 * F.col("query_id") + F.col("caller"))
    found = se.search(documents_index(spark, sf), queries, se.SearchSpec(("source",), 3, grants=grants, grant_column="source"))
    return found.select("query_id", "rank", "score", "doc_id", "source")


@query(
    "row_grants",
    """SELECT query_id, rank, score, doc_id, source FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
      FROM {{cosines}} JOIN documents USING (doc_id)
      WHERE source IN (SELECT 'src' || CAST(CAST(props->>'$.k' AS INTEGER) % 20 AS VARCHAR) FROM events
        WHERE event_type = 'purchase' AND user_id = (
          SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)))
    WHERE rank <= 3""",
)
def row_grants(spark, sf):
    grants = purchases(spark, sf, 1).select("source").distinct()
    return run(spark, sf, se.SearchSpec(("source",), 3, grants=grants, grant_column="source"))


@query(
    "ann_ivf_all",
    f"""SELECT query_id, rank, score, key AS vec_id, label FROM ({knn_sql('cosine')})
    JOIN (SELECT vec_id AS key, label FROM embeddings) USING (key)""",
)
def ann_ivf_all(spark, sf):
    """Visiting every cell finds what an exact search finds."""
    index = vectors_index(spark, sf)
    return se.search(index, centroids(spark, sf), se.SearchSpec(("label",), 10, nprobe=index.info["n_cells"]))


@query(
    "knn_many_queries",
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    n AS (SELECT vec_id, sqrt(sum(x * x)) AS len FROM e GROUP BY ALL),
    d AS (SELECT a.vec_id AS query_id, b.vec_id AS key, sum(a.x * b.x) AS dot FROM e a JOIN e b USING (i) GROUP BY ALL),
    s AS (SELECT query_id, key, round(dot / (a.len * b.len), 6) AS score FROM d
      JOIN n a ON a.vec_id = query_id JOIN n b ON b.vec_id = key WHERE a.len > 0 AND b.len > 0)
    SELECT query_id, key, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS INTEGER) AS rank
    FROM s QUALIFY rank <= 5""",
)
def knn_many_queries(spark, sf):
    """Every vector asks for its five nearest in all cells, with queries dealt to the cells they visit."""
    index = vectors_index(spark, sf)
    vectors = index.live("vectors").select("key", "vector", "cell")
    asking = vectors.select(F.col("key").alias("query_id"), "vector")
    asking = asking.withColumn("probes", cells.nearest_cells(F.col("vector"), index.centres, index.info["n_cells"]))
    return topk.spread(vectors, asking, 5, within="cells").select("query_id", "key", "score", "rank")


@query("ann_ivf")
def ann_ivf(spark, sf):
    return se.search(vectors_index(spark, sf), centroids(spark, sf), se.SearchSpec(("label",), 10, nprobe=8))


BANDS, BITS = 16, 6


def _banded(df):
    return df.withColumn("bands", cells.band_keys(F.col("vector"), 64, BANDS, BITS))


PLANES_SQL = ", ".join(
    f"({i}, {p}, {w!r})" for (i, p), w in np.ndenumerate(cells.hyperplanes(64, BANDS, BITS).astype(object))
)
BANDED_SQL = """SELECT {key}, p // {bits} * {size} + CAST(sum(CASE WHEN s THEN 1 << (p % {bits}) ELSE 0 END) AS BIGINT) AS band
    FROM (SELECT {key}, p, sum(x * w) > 0 AS s FROM {rows} JOIN planes USING (i) GROUP BY ALL) GROUP BY {key}, p // {bits}"""


def _banded_sql(key: str, rows: str) -> str:
    return BANDED_SQL.format(key=key, rows=rows, bits=BITS, size=1 << BITS)


@query(
    "ann_lsh",
    f"""WITH {KNN_PARTS}, planes(i, p, w) AS (VALUES {PLANES_SQL}),
    near AS (SELECT DISTINCT query_id, vec_id FROM ({_banded_sql('query_id', 'q')}) JOIN ({_banded_sql('vec_id', 'e')}) USING (band)),
    s AS (SELECT query_id, vec_id AS key, round({METRIC_SQL['cosine'][0]}, 6) AS score
      FROM near JOIN q USING (query_id) JOIN e USING (vec_id, i) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS rank FROM s)
    SELECT query_id, key, score, rank FROM r WHERE rank <= 10""",
)
def ann_lsh(spark, sf):
    found = cells.banded_search(
        spark.table(bands_table(spark, sf)), stored_vectors(spark, sf), centroids(spark, sf), 10, 64, BANDS, BITS
    )
    return found.select("query_id", "key", "score", "rank")


def bands_table(spark, sf):
    """The stored bands of `embeddings`, built once per application and data folder."""

    def build(spark, sf):
        table = f"{scratch_database(spark)}.bands_{uuid.uuid4().hex[:8]}"
        cells.write_bands(stored_vectors(spark, sf), table, 64, BANDS, BITS)
        return table

    return once(spark, sf, "bands", build)


@query("ann_recall")
def ann_recall(spark, sf):
    """Recall@10 against the exact lists, always with the share of vectors scored."""
    index = vectors_index(spark, sf)
    vectors = index.live("vectors").select("key", "vector", "cell")
    n = index.info["n_docs"]
    queries = written(spark, centroids(spark, sf), "queries")
    exact = written(spark, topk.nearest(vectors, queries, 10), "exact")
    report = None
    trials = [("cells", p) for p in (1, 4, 8, 16)] + [("bands", BANDS)]
    for way, setting in trials:
        if way == "cells":
            asking = queries.withColumn("probes", cells.nearest_cells(F.col("vector"), index.centres, setting))
            base = vectors
        else:
            asking, base = _banded(queries), _banded(vectors)
        found = topk.nearest(base, asking, 10, within=way)
        seen = topk.nearest(base, asking, 10, within=way, count_only=True)
        row = (
            rank.recall(found, exact)
            .join(seen, "query_id", "left")
            .agg(
                F.lit(way).alias("method"),
                F.lit(setting).alias("setting"),
                F.round(F.avg("recall"), 4).alias("recall_at_10"),
                F.round(F.avg(F.coalesce("n_scored", F.lit(0))) / n, 4).alias("share_scored"),
            )
        )
        report = row if report is None else report.unionByName(row)
    return report


@query(
    "precision_at_k",
    f"""SELECT query_id, count(*) AS n_hits, round(avg(CASE WHEN label = query_id THEN 1 ELSE 0 END), 6) AS precision
    FROM ({knn_sql('cosine')}) JOIN (SELECT vec_id AS key, label FROM embeddings) USING (key) GROUP BY query_id""",
)
def precision_at_k(spark, sf):
    hits = topk.nearest(stored_vectors(spark, sf), centroids(spark, sf), 10)
    relevant = load(spark, sf, "embeddings").select(F.col("label").alias("query_id"), F.col("vec_id").alias("key"))
    return rank.precision(hits, relevant)


@query("dimension_study")
def dimension_study(spark, sf):
    """Recall@10 of shortened vectors against the full ones, by cutting and by PCA."""
    full, queries = stored_vectors(spark, sf), written(spark, centroids(spark, sf), "queries")
    exact = written(spark, topk.nearest(full, queries, 10), "exact")
    report = None
    for dim in (48, 32, 16):
        project = embed.principal_axes(full, "vector", dim)
        for way, shorten in (("slice", lambda v: vx.shorten(v, dim)), ("pca", project)):
            small = [df.withColumn("vector", shorten(F.col("vector"))) for df in (full, queries)]
            found = topk.nearest(small[0], small[1], 10)
            row = rank.recall(found, exact).agg(
                F.lit(way).alias("method"), F.lit(dim).alias("dim"), F.round(F.avg("recall"), 4).alias("recall_at_10")
            )
            report = row if report is None else report.unionByName(row)
    return report
