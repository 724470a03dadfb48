"""Chunking and embedding."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.functions import vectors as vx
from docsift.operators import chunk, clean, embed, recursive
from docsift.registry.base import bucket, load, nonblank, query, sentences, sign, toks, words
from docsift.registry.parsing import VECTOR_SQL, _whole_numbers, clean_elements, turns


def docs(spark, sf, *more):
    return load(spark, sf, "documents").select("doc_id", "text", *more)


def numbered(pieces: str, table: str = "documents", key: str = "doc_id") -> str:
    return f"""SELECT {key}, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS chunk
    FROM (SELECT {key}, {pieces} AS p FROM {table})"""


FIXED_SQL = """SELECT doc_id, CAST(i AS INTEGER) AS pos, substr(text, i * 800 + 1, 1000) AS chunk
    FROM (SELECT doc_id, text, unnest(range(1 + CAST(greatest(0, ceil((length(text) - 1000) / 800.0)) AS BIGINT))) AS i
          FROM documents WHERE length(text) > 0)"""


@query("chunk_fixed_chars", FIXED_SQL)
def chunk_fixed_chars(spark, sf):
    return chunk.fixed_chars(docs(spark, sf), ["doc_id"], "text", 1000, 200)


@query(
    "chunk_fixed_tokens",
    f"""SELECT doc_id, CAST(i AS INTEGER) AS pos, array_to_string(w[i * 450 + 1 : i * 450 + 500], ' ') AS chunk
    FROM (SELECT doc_id, w, unnest(range(1 + CAST(greatest(0, ceil((len(w) - 500) / 450.0)) AS BIGINT))) AS i
          FROM (SELECT doc_id, {words('text')} AS w FROM documents) WHERE len(w) > 0)""",
)
def chunk_fixed_tokens(spark, sf):
    return chunk.fixed_tokens(docs(spark, sf), ["doc_id"], "text", 500, 50)


@query(
    "chunk_pages",
    """SELECT conv_id AS path,
      CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, t AS chunk
    FROM (SELECT conv_id, turn, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM conversations) WHERE t <> ''""",
)
def chunk_pages(spark, sf):
    return chunk.by_pages(clean.plain_text(turns(spark, sf)), ["path"], "plain_text")


@query("chunk_nonblank", "SELECT conv_id, turn, text FROM conversations WHERE regexp_matches(text, '\\S')")
def chunk_nonblank(spark, sf):
    return chunk.nonblank(load(spark, sf, "conversations").select("conv_id", "turn", "text"), "text")


@query("chunk_sentences", numbered(sentences("text")))
def chunk_sentences(spark, sf):
    return chunk.by_sentences(docs(spark, sf), ["doc_id"], "text")


@query("chunk_paragraphs", numbered(nonblank("string_split_regex(text, '\\n+')")))
def chunk_paragraphs(spark, sf):
    return chunk.by_paragraphs(docs(spark, sf), ["doc_id"], "text", r"\n+")


@query(
    "chunk_packed_sentences",
    numbered(f"""string_split(list_reduce({sentences('text')}, lambda a, s:
      CASE WHEN length(list_last(string_split(a, chr(2)))) + 1 + length(s) <= 1000 THEN a || ' ' || s
        ELSE a || chr(2) || s END), chr(2))""", f"(SELECT * FROM documents WHERE len({sentences('text')}) > 0)"),
)
def chunk_packed_sentences(spark, sf):
    return chunk.packed_sentences(docs(spark, sf), "doc_id", "text", 1000)


@query(
    "chunk_headers",
    f"""SELECT path, pos, concat_ws(' > ', h1,
        CASE WHEN p2 > coalesce(p1, -1) THEN h2 END) AS heading_path, chunk
    FROM (SELECT *, last_value(CASE WHEN level = 1 THEN title END IGNORE NULLS) OVER w AS h1,
            last_value(CASE WHEN level = 1 THEN pos END IGNORE NULLS) OVER w AS p1,
            last_value(CASE WHEN level = 2 THEN title END IGNORE NULLS) OVER w AS h2,
            last_value(CASE WHEN level = 2 THEN pos END IGNORE NULLS) OVER w AS p2
          FROM (SELECT *, length(regexp_extract(chunk, '^(#{{1,6}}) ', 1)) AS level,
                  regexp_extract(chunk, '^#{{1,6}} ([^\\n]*)', 1) AS title
                FROM (SELECT path, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS chunk
                      FROM (SELECT path, {nonblank("string_split(regexp_replace(markdown, '(?m)^(#{1,6} )', chr(1) || '\\1', 'g'), chr(1))")} AS p
                            FROM {{{{page_markdown}}}})))
          WINDOW w AS (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
)
def chunk_headers(spark, sf):
    return chunk.by_headers(clean.markdown(clean_elements(spark, sf)), ["path"], "markdown")


@query(
    "chunk_with_title",
    f"SELECT doc_id, pos, chunk, concat_ws(' | ', source, lang) || chr(10) || chunk AS full_chunk FROM ({FIXED_SQL}) JOIN (SELECT doc_id, source, lang FROM documents) USING (doc_id)",
)
def chunk_with_title(spark, sf):
    pieces = chunk.fixed_chars(docs(spark, sf, "source", "lang"), ["doc_id", "source", "lang"], "text", 1000, 200)
    titled = chunk.with_header(pieces, [F.col("source"), F.col("lang")])
    return titled.select("doc_id", "pos", "chunk", "full_chunk")


SEMANTIC_PARTS = f"""
    sent AS (SELECT doc_id, unnest(range(len(p))) AS i, unnest(p) AS s
             FROM (SELECT doc_id, {sentences('text')} AS p FROM documents)),
    st AS (SELECT doc_id, i, unnest({toks('s')}) AS term FROM sent),
    sv AS (SELECT doc_id, i, {bucket('term')} AS b, sum({sign('term')})::DOUBLE AS c FROM st GROUP BY ALL),
    sn AS (SELECT doc_id, i, sum(c * c) AS n FROM sv GROUP BY ALL HAVING sum(c * c) > 0),
    sd AS (SELECT a.doc_id, b.i, sum(a.c * b.c) AS dot FROM sv a JOIN sv b
           ON a.doc_id = b.doc_id AND b.i = a.i + 1 AND a.b = b.b GROUP BY ALL),
    cuts AS (SELECT s.doc_id, s.i, s.s,
               CASE WHEN s.i = 0 THEN 1
                    WHEN round(coalesce(sd.dot, 0) / (sqrt(x.n) * sqrt(y.n)), 6) < 0.1 THEN 1 ELSE 0 END AS cut
             FROM sent s LEFT JOIN sn x ON x.doc_id = s.doc_id AND x.i = s.i
             LEFT JOIN sn y ON y.doc_id = s.doc_id AND y.i = s.i - 1
             LEFT JOIN sd ON sd.doc_id = s.doc_id AND sd.i = s.i)"""


@query(
    "chunk_semantic",
    f"""WITH {SEMANTIC_PARTS}
    SELECT doc_id, CAST(g - 1 AS INTEGER) AS pos, string_agg(s, ' ' ORDER BY i) AS chunk
    FROM (SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM cuts) GROUP BY doc_id, g""",
)
def chunk_semantic(spark, sf):
    return chunk.semantic(docs(spark, sf), ["doc_id"], "text", 0.1)


@query(
    "chunk_windowed_summary",
    f"""WITH c AS (SELECT doc_id, unnest(range(len(p))) AS i, unnest(p) AS chunk
        FROM (SELECT doc_id, {nonblank("string_split_regex(text, '\\n+')")} AS p FROM documents))
    SELECT doc_id, CAST(i AS INTEGER) AS pos, coalesce(string_agg(lead, ' ') OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS before, chunk
    FROM (SELECT *, {sentences('chunk')}[1] AS lead FROM c)""",
)
def chunk_windowed_summary(spark, sf):
    return chunk.windowed_summary(docs(spark, sf), ["doc_id"], chunk.paragraphs(F.col("text"), r"\n+"))


@query(
    "context_window_check",
    f"""SELECT doc_id, n AS n_tokens, n <= 512 AS fits, greatest(n - 512, 0) AS excess,
      CAST(greatest(ceil(n / 512.0), 1) AS INTEGER) AS n_parts
    FROM (SELECT doc_id, CAST(len({words('text')}) AS INTEGER) AS n FROM documents)""",
)
def context_window_check(spark, sf):
    return chunk.fit_report(docs(spark, sf), ["doc_id"], "text", 512)


@query(
    "context_window_truncate",
    f"""SELECT doc_id, 0 AS pos, CASE WHEN len(w) > 512 THEN array_to_string(w[1:512], ' ') ELSE text END AS chunk
    FROM (SELECT doc_id, text, {words('text')} AS w FROM documents)""",
)
def context_window_truncate(spark, sf):
    return chunk.fit(docs(spark, sf), ["doc_id"], "text", 512, "truncate")


@query(
    "context_window_split",
    f"""SELECT doc_id, CAST(i AS INTEGER) AS pos, array_to_string(w[i * 512 + 1 : i * 512 + 512], ' ') AS chunk
    FROM (SELECT doc_id, w, unnest(range(CAST(ceil(len(w) / 512.0) AS BIGINT))) AS i
          FROM (SELECT doc_id, {words('text')} AS w FROM documents) WHERE len(w) > 0)""",
)
def context_window_split(spark, sf):
    return chunk.fit(docs(spark, sf), ["doc_id"], "text", 512, "split")


@query(
    "chunk_ids",
    f"""SELECT doc_id, pos, md5(doc_id || '#' || pos) AS chunk_id,
      CAST('0x' || substr(md5(doc_id || '#' || pos), 1, 15) AS BIGINT) AS id FROM ({FIXED_SQL})""",
)
def chunk_ids(spark, sf):
    pieces = chunk.fixed_chars(docs(spark, sf), ["doc_id"], "text", 1000, 200)
    return chunk.chunk_ids(pieces, ["doc_id", "pos"]).select("doc_id", "pos", "chunk_id", "id")


SIZES = [(250, 50), (500, 100), (1000, 200), (2000, 200), (2000, 400)]


@query(
    "chunk_size_study",
    f"""SELECT size, overlap, CAST(sum(k) AS BIGINT) AS n_chunks,
      round(sum(n + (k - 1) * overlap) / sum(k), 6) AS mean_chars,
      round(sum(n + (k - 1) * overlap) / sum(n) - 1, 6) AS repeated_share
    FROM (SELECT *, 1 + greatest(0, ceil((n - size) / CAST(size - overlap AS DOUBLE))) AS k
          FROM (SELECT length(text)::DOUBLE AS n FROM documents WHERE length(text) > 0),
               (VALUES {', '.join(str(s) for s in SIZES)}) AS o(size, overlap))
    GROUP BY size, overlap""",
)
def chunk_size_study(spark, sf):
    return chunk.size_study(load(spark, sf, "documents"), "text", SIZES)


@query("chunk_recursive_pages")
def chunk_recursive_pages(spark, sf):
    text = clean.plain_text(turns(spark, sf))
    return recursive.split_documents(
        text, "path", "plain_text", recursive.PAGE_SIZE, recursive.OVERLAP, recursive.PAGE_SEPARATORS
    )


@query("chunk_recursive_default")
def chunk_recursive_default(spark, sf):
    return recursive.split_documents(docs(spark, sf), "doc_id", "text")


@query("chunk_udf_explode")
def chunk_udf_explode(spark, sf):
    return recursive.split_column(docs(spark, sf), "doc_id", "text")


@query("embed_hashed", VECTOR_SQL)
def embed_hashed(spark, sf):
    return embed.embed(docs(spark, sf), "text", embed.HashedModel()).select("doc_id", _whole_numbers("vector"))


@query(
    "embed_user_fn",
    """SELECT doc_id, length(text) || ' ' || length(regexp_replace(text, '[^ ]', '', 'g')) || ' ' ||
      length(regexp_replace(text, '[^.]', '', 'g')) AS vector FROM documents""",
)
def embed_user_fn(spark, sf):
    def load_model():
        import numpy as np

        return lambda texts: np.array([[len(t), t.count(" "), t.count(".")] for t in texts], dtype=np.float32)

    model = embed.FunctionModel("three-counts", 3, load_model)
    return embed.embed(docs(spark, sf), "text", model).select("doc_id", _whole_numbers("vector"))


@query(
    "vector_check",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_values,
      len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AS ok
    FROM embeddings""",
)
def vector_check(spark, sf):
    return embed.vector_report(load(spark, sf, "embeddings"), "vec_id", "embedding", 64)


def _unit_sql(dim: int) -> str:
    return f"""SELECT vec_id, string_agg(CAST(round(x / len * 1000000) AS BIGINT)::VARCHAR, ' ' ORDER BY i) AS micro
    FROM (SELECT vec_id, i, x, sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS len
          FROM (SELECT vec_id, unnest(embedding[1:{dim}])::DOUBLE AS x, unnest(range({dim})) AS i FROM embeddings))
    GROUP BY vec_id"""


@query("vector_normalise", _unit_sql(64))
def vector_normalise(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", vx.micro(vx.normalise(F.col("embedding"))).alias("micro"))


@query("vector_slice", _unit_sql(32))
def vector_slice(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", vx.micro(vx.shorten(F.col("embedding"), 32)).alias("micro"))
