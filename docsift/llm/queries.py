"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import bpe, decontaminate, language, line_templates, mixture, near_duplicates, page_diff, pii, quality, spelling, store, token_records, va_file, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(store.settle(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_records")
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of `documents` written as binary records and read back."""
    docs = store.text_of(store.load(spark, sf_dir, "documents"))
    folder = store.folder(spark, "token-records")
    return token_records.read(spark, token_records.write(spark, docs, folder, vocabulary("byte_bpe_50k.json")))


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of `documents` by the rank file, and the bytes that they decode to, as digests."""
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(spark, store.text_of(store.load(spark, sf_dir, "documents")), ranks)
    return bpe.digests(bpe.decode(encoded, ranks))


_WORDS = r"list_filter(regexp_extract_all(translate(text, '{up}', '{low}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
_WORDS = _WORDS.format(up="ABCDEFGHIJKLMNOPQRSTUVWXYZ", low="abcdefghijklmnopqrstuvwxyz")

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op3_near_duplicates",
    f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS sh FROM d),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY ALL),
    link AS (
      SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * i >= 80 * (na.n + nb.n - i)),
    reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
    least AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
      least(d.doc_id, coalesce(b, d.doc_id)) AS component_id, d.doc_id <= coalesce(b, d.doc_id) AS kept
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
)
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of `documents` whose four-word shingle sets are similar to 0.8 or more."""
    return near_duplicates.groups(spark, store.text_of(store.load(spark, sf_dir, "documents")), words=4, percent=80)


@query(
    "op9_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
    iw AS (
      SELECT DISTINCT item, unnest(CASE WHEN len(w) < 13 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' ')) END) AS win,
        least(len(w), 13) AS n
      FROM b WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT n FROM iw),
    dw AS (
      SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
        unnest(list_transform(range(1, len(w) - n + 2), lambda j: array_to_string(w[j:j + n - 1], ' '))) AS win
      FROM d, sizes WHERE len(w) >= n),
    found AS (SELECT doc_id, i, n, item FROM dw JOIN iw USING (win, n)),
    hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
    of AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN of USING (doc_id)""",
)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of windows of `benchmark` in `documents`."""
    docs = store.text_of(store.load(spark, sf_dir, "documents"))
    return decontaminate.report(decontaminate.find(spark, docs, store.load(spark, sf_dir, "benchmark")))


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of `documents`, learned from the labels of four of five folds."""
    rows = store.keep(spark, quality.measured(store.text_of(store.load(spark, sf_dir, "documents"))), "statistics")
    labels = store.load(spark, sf_dir, "labels").select(F.col("doc_id").cast("long"), F.col("quality").alias("y"))
    model = quality.fit(spark, rows, labels.where(quality.fold() != 0))
    held_out = F.coalesce(quality.fold() == 0, F.lit(False))
    return quality.scored(rows, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


_TOKENS = (
    "list_transform(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x20\\x09-\\x0D]+'), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END)"
)


@query(
    "op5_line_templates",
    f"""
    WITH l AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
      FROM documents),
    t AS (SELECT doc_id, pos, line, {_TOKENS} AS w FROM l),
    k AS (SELECT *, len(w) AS n, len(w) - 3 AS r FROM t),
    keys AS (
      SELECT doc_id, pos, n || '|' || array_to_string(w, ' ') AS template FROM k WHERE n >= 5
      UNION ALL
      SELECT doc_id, pos, n || '|' || i || '|' || array_to_string(w[1:3 + r * i // 5], ' ') || '|'
        || array_to_string(w[4 + r * (i + 1) // 5:], ' ')
      FROM k, range(5) f(i) WHERE n >= 10 AND r * (i + 1) // 5 > r * i // 5),
    rec AS (SELECT template, min(doc_id) AS first FROM keys GROUP BY template HAVING count(DISTINCT doc_id) >= 2),
    lost AS (SELECT DISTINCT doc_id, pos FROM keys JOIN rec USING (template) WHERE doc_id > first),
    counts AS (
      SELECT doc_id, count(*) FILTER (WHERE n > 0) AS n_lines, count(*) FILTER (WHERE lost.pos IS NOT NULL) AS n_dropped,
        string_agg(line, chr(10) ORDER BY k.pos) FILTER (WHERE lost.pos IS NULL) AS text
      FROM k LEFT JOIN lost USING (doc_id, pos) GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
      CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.text, '') END AS text
    FROM documents d LEFT JOIN counts c USING (doc_id)""",
)
def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` without the lines whose template an earlier document has."""
    left = line_templates.dedup_lines(spark, store.text_of(store.load(spark, sf_dir, "documents")))
    return left.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), "text"
    )


@query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of `documents`, learned from the languages of two of three folds."""
    table = store.load(spark, sf_dir, "documents")
    docs = store.text_of(table)
    train = table.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = language.fit(spark, train.where(quality.fold(parts=3) != 1))
    held_out = F.coalesce(quality.fold(parts=3) == 1, F.lit(False))
    return language.predicted(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query(
    "op6_va_file",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 10""",
)
def op6_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors of `embeddings` for every hundredth of them."""
    vectors = va_file.whole_vectors(store.load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    queries = vectors.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    return va_file.top_k(spark, vectors, queries, k=10)


@query("op2_page_diff")
def op2_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of `pages`."""
    return page_diff.extract(spark, store.load(spark, sf_dir, "pages"))


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in `documents`."""
    return pii.report(pii.find(spark, store.text_of(store.load(spark, sf_dir, "documents"))))


_AGAIN = """
    d{i} AS MATERIALIZED (
      SELECT s.vec_id, s.k, s.p, s.v, min(list_sum(list_transform(list_zip(s.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + c.e) AS near
      FROM s JOIN c{i} c USING (p) GROUP BY ALL),"""
_MEANS = """
    m{i} AS (
      SELECT p, near % 64 AS e, j, CAST(floor(sum(v[j]) / count(*)) AS BIGINT) AS x
      FROM d{i}, range(1, 5) t(j) GROUP BY ALL),
    c{j} AS MATERIALIZED (
      SELECT c.p, c.e, coalesce(m.v, c.v) AS v
      FROM c{i} c LEFT JOIN (SELECT p, e, list(x ORDER BY j) AS v FROM m{i} GROUP BY ALL) m USING (p, e)),"""


@query(
    "op11_vector_codes",
    f"""
    WITH w AS (
      SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS k, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS MATERIALIZED (SELECT vec_id, k, p, v[4 * p + 1:4 * p + 4] AS v FROM w, range(16) t(p)),
    c0 AS MATERIALIZED (SELECT p, k AS e, v FROM s WHERE k < 64),
    {_AGAIN.format(i=0)}{_MEANS.format(i=0, j=1)}
    {_AGAIN.format(i=1)}{_MEANS.format(i=1, j=2)}
    {_AGAIN.format(i=2)}
    codes AS (
      SELECT k, string_agg(printf('%02x', CAST(near % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(near // 64) AS BIGINT) AS error
      FROM d2 GROUP BY k),
    books AS (
      SELECT sha256(coalesce(string_agg(x, ',' ORDER BY p, e), '')) AS codebooks_sha256
      FROM (SELECT p, e, array_to_string(v, ',') AS x FROM c2))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM codes JOIN w USING (k), books""",
)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of sixteen parts for every vector of `embeddings`."""
    return vector_codes.compress(spark, store.load(spark, sf_dir, "embeddings"))


@query(
    "op12_mixture",
    r"""
    WITH d AS (
      SELECT doc_id, source,
        CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        CAST('0x' || substr(md5('20:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT)
          / 4503599627370496.0::DOUBLE AS u
      FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [3.0::DOUBLE, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
      FROM d GROUP BY source),
    r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS i FROM s),
    f AS (
      SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS among
      FROM r),
    g AS (SELECT *, weight * rest / among > cap AS above FROM f),
    k AS (SELECT coalesce(max(i) FILTER (WHERE above), 0) AS full_ FROM g),
    l AS (SELECT rest, among FROM g, k WHERE i = full_ + 1),
    t AS (
      SELECT source, source_size, CASE WHEN i <= full_ THEN cap ELSE weight * (SELECT rest FROM l) / (SELECT among FROM l) END AS target
      FROM g, k),
    p AS (
      SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
      CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM p""",
)
def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of one and a half times `documents` takes."""
    docs = store.load(spark, sf_dir, "documents")
    plan = mixture.planned(spark, mixture.measured(docs))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query(
    "op13_spelling",
    r"""
    WITH RECURSIVE crc AS (
      SELECT list_transform(range(256), lambda b: list_reduce(
        list_prepend(b, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS tab),
    runs AS (
      SELECT doc_id, run, count(*) AS n
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS raw FROM documents),
        LATERAL (SELECT translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run)
      WHERE length(raw) >= 6 GROUP BY ALL),
    coded AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
    hashed AS (
      SELECT run, n, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
      FROM coded, crc),
    v AS MATERIALIZED (
      SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
        CAST(sum(n) AS BIGINT) AS n
      FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
    less AS MATERIALIZED (
      SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM v, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
    near AS MATERIALIZED (
      SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM v a JOIN less b ON a.word = b.rest
      UNION SELECT b.word, a.word, a.n FROM v a JOIN less b ON a.word = b.rest),
    counts AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
    best AS (SELECT word, other, n AS other_n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
    f AS MATERIALIZED (
      SELECT word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
        CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
      FROM v LEFT JOIN counts USING (word) LEFT JOIN best USING (word)),
    up(word, root) AS (
      SELECT word, word FROM f WHERE form IS NULL
      UNION ALL SELECT f.word, up.root FROM f JOIN up ON f.form = up.word)
    SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM f JOIN up USING (word)""",
)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of `documents` with their near words, forms and roots."""
    return spelling.variants(spark, store.load(spark, sf_dir, "documents"), every=spelling.EVERY)
