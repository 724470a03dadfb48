"""Sources, tables, parsing, cleaning and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.operators import chunk, clean, embed, metadata, parse
from docsift.plans import index, layers
from docsift.registry.base import load, nonblank, query
from docsift.session import scratch_database
from docsift.sources import files, tables


def elements(spark, sf):
    return parse.parse_elements(load(spark, sf, "pages"), "page_id", "html")


def clean_elements(spark, sf):
    return parse.drop_noise(elements(spark, sf))


def turns(spark, sf):
    """Conversations as documents: one page per turn, one element per page."""
    return load(spark, sf, "conversations").select(
        F.col("conv_id").alias("path"),
        F.col("turn").cast("int").alias("page"),
        F.lit(0).alias("pos"),
        F.lit("text").alias("type"),
        F.col("role").alias("region"),
        F.lit(None).cast("int").alias("level"),
        F.col("text").alias("content"),
    )


@query("read_parquet_chunks", "SELECT doc_id AS chunk_id, source AS path, text AS chunk FROM documents")
def read_parquet_chunks(spark, sf):
    rows = files.read_chunks(spark, f"{sf}/documents.parquet")
    return rows.select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("path"), F.col("text").alias("chunk"))


@query("sample_rows", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def sample_rows(spark, sf):
    return files.sample_rows(load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id", 5)


@query("read_binary_files")
def read_binary_files(spark, sf):
    return files.sha256_of(spark, sf, "*.parquet")


@query("read_files_sql")
def read_files_sql(spark, sf):
    pieces = files.read_pieces(spark.sql(files.read_files_sql(sf)))
    return pieces.groupBy("path", "length").agg(F.sum(F.octet_length("content")).alias("n_bytes"))


@query("list_files")
def list_files(spark, sf):
    return files.list_files(spark, sf, "*.parquet")


@query("table_flag", "SELECT source, count(*) AS n_rows, false AS flag_before, true AS flag_after FROM documents GROUP BY source")
def table_flag(spark, sf):
    table = f"{scratch_database(spark)}.flagged_documents"
    tables.drop(spark, table)
    tables.register_parquet(spark, table, f"{sf}/documents.parquet")
    before = tables.change_feed_enabled(spark, table)
    tables.enable_change_feed(spark, table)
    tables.require_change_feed(spark, table)
    return spark.table(table).groupBy("source").agg(
        F.count("*").alias("n_rows"),
        F.lit(before).alias("flag_before"),
        F.lit(tables.change_feed_enabled(spark, table)).alias("flag_after"),
    )


@query(
    "overwrite_merge_schema",
    "SELECT doc_id, lang, length(text) AS n_text, CAST(NULL AS VARCHAR) AS source FROM documents",
)
def overwrite_merge_schema(spark, sf):
    docs = load(spark, sf, "documents")
    table = f"{scratch_database(spark)}.merged_documents"
    tables.overwrite(docs.select("doc_id", "source", "lang"), table)
    tables.overwrite_merging_schema(docs.select("doc_id", "lang", F.length("text").cast("bigint").alias("n_text")), table)
    return spark.table(table).select("doc_id", "lang", "n_text", "source")


@query(
    "asset_table",
    """SELECT page_id AS path, 1 AS page, CAST(unnest(range(len(r))) AS INTEGER) AS pos, unnest(r) AS ref
    FROM (SELECT page_id, regexp_extract_all(html, '(?:src|href)="([^"]*)"', 1) AS r FROM pages)""",
)
def asset_table(spark, sf):
    table = f"{scratch_database(spark)}.page_assets"
    tables.overwrite(parse.references(load(spark, sf, "pages"), "page_id", "html"), table)
    return spark.table(table)


VECTOR_SQL = """
    SELECT doc_id, string_agg(CAST(coalesce(c, 0) AS BIGINT)::VARCHAR, ' ' ORDER BY b) AS vector
    FROM (SELECT doc_id, unnest(range(64)) AS b FROM documents) LEFT JOIN {{dvec}} USING (doc_id, b)
    GROUP BY doc_id"""


def _whole_numbers(column: str):
    return F.array_join(F.transform(column, lambda x: x.cast("bigint")), " ").alias("vector")


@query("save_vectors", VECTOR_SQL)
def save_vectors(spark, sf):
    from docsift.registry.indexing import documents_index

    table = f"{scratch_database(spark)}.document_vectors"
    index.save_vectors(documents_index(spark, sf), table, save=True)
    return spark.table(table).select(F.col("key").alias("doc_id"), _whole_numbers("vector"))


@query("layer_tables", """
    SELECT 'bronze' AS layer, count(*) AS n_rows FROM pages
    UNION ALL SELECT 'silver', count(*) FROM {{clean_elements}}
    UNION ALL SELECT 'gold', CAST(sum(1 + greatest(0, ceil((n - 1000) / 800.0))) AS BIGINT)
    FROM (SELECT sum(length(content)) + count(*) - 1 AS n FROM {{clean_elements}} GROUP BY path)""")
def layer_tables(spark, sf):
    names = layers.build_layers(load(spark, sf, "pages"), scratch_database(spark), "page_id", "html")
    counts = [
        spark.table(table).agg(F.lit(layer).alias("layer"), F.count("*").alias("n_rows"))
        for layer, table in names.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("parse_elements", "SELECT * FROM {{elements}}")
def parse_elements(spark, sf):
    return elements(spark, sf)


@query("element_filter", "SELECT path, pos, type, content FROM {{elements}} WHERE type IN ('title', 'header')")
def element_filter(spark, sf):
    return parse.keep_types(elements(spark, sf), ["title", "header"]).select("path", "pos", "type", "content")


@query(
    "caption_join",
    """SELECT path, page, pos, caption, content FROM (
      SELECT *, coalesce(
        CASE WHEN lag(type) OVER w = 'header' THEN lag(content) OVER w END,
        CASE WHEN lead(type) OVER w = 'header' THEN lead(content) OVER w END) AS caption
      FROM {{clean_elements}} WINDOW w AS (PARTITION BY path ORDER BY pos))
    WHERE type = 'text'""",
)
def caption_join(spark, sf):
    return parse.attach_captions(clean_elements(spark, sf), "header", "text")


@query(
    "noise_removed",
    """SELECT path, page, pos, type, region, level, content FROM {{clean_elements}}
    WHERE content NOT IN (SELECT content FROM {{clean_elements}} GROUP BY content HAVING count(DISTINCT path) >= 3)""",
)
def noise_removed(spark, sf):
    return parse.drop_noise(elements(spark, sf), repeated_in=3)


@query(
    "repeated_lines",
    f"""WITH lines AS (SELECT doc_id, unnest({nonblank("string_split(text, chr(10))")}) AS line FROM documents)
    SELECT line, count(DISTINCT doc_id) AS n_docs FROM lines GROUP BY line HAVING count(DISTINCT doc_id) >= 3""",
)
def repeated_lines(spark, sf):
    lines = F.array_distinct(chunk.paragraphs(F.col("text"), "\n"))
    return (
        load(spark, sf, "documents")
        .select(F.explode_outer(lines).alias("line"))
        .filter(F.col("line").isNotNull())
        .groupBy("line")
        .agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") >= 3)
    )


@query(
    "parse_report",
    """SELECT path, page, type, count(*) AS n_elements, CAST(sum(length(content)) AS BIGINT) AS n_chars
    FROM {{elements}} GROUP BY ALL""",
)
def parse_report(spark, sf):
    return parse.parse_report(elements(spark, sf))


@query(
    "variant_paths",
    "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, CAST(props->>'$.k' AS INTEGER) AS k_path FROM events",
)
def variant_paths(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.parse_json("props").alias("v"))
    return rows.select("event_id", F.variant_get("v", "$.k", "int").alias("k"), F.expr("v:k::int").alias("k_path"))


@query(
    "parsed_variant",
    """SELECT path, count(*) AS n_elements, count(DISTINCT page) AS n_pages,
      arg_min(type, pos) AS first_type, arg_min(content, pos) AS first_content, '2.0' AS version
    FROM {{elements}} GROUP BY path""",
)
def parsed_variant(spark, sf):
    parsed = parse.check_version(parse.parsed_documents(elements(spark, sf)))
    items = "cast(variant_get(parsed_content, '$.document.{}') as array<variant>)"
    return parsed.select(
        "path",
        F.expr(f"size({items.format('elements')})").cast("bigint").alias("n_elements"),
        F.expr(f"size({items.format('pages')})").cast("bigint").alias("n_pages"),
        F.expr("parsed_content:document.elements[0].type::string").alias("first_type"),
        F.expr("parsed_content:document.elements[0].content::string").alias("first_content"),
        F.expr("parsed_content:version::string").alias("version"),
    )


def spoiled_files(spark, sf):
    """Pages as file bytes; every tenth has a byte that is no UTF-8."""
    bytes_ = F.encode("html", "UTF-8")
    bad = F.concat(bytes_, F.unhex(F.lit("FF")))
    return load(spark, sf, "pages").select(
        F.col("page_id").alias("path"), F.when(F.col("page_id") % 10 == 0, bad).otherwise(bytes_).alias("content")
    )


@query("parse_from_bytes", "SELECT * FROM {{elements}} WHERE path % 10 <> 0")
def parse_from_bytes(spark, sf):
    return parse.parse_elements(parse.decoded(spoiled_files(spark, sf), "path", "content"), "path", "html")


@query(
    "parsed_status",
    """SELECT page_id AS path, CAST(strlen(html) + CASE WHEN page_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS size,
      CASE WHEN page_id % 10 = 0 THEN 'not UTF-8' END AS error_status,
      CASE WHEN page_id % 10 <> 0 THEN coalesce(n, 0) ELSE 0 END AS n_elements,
      CASE WHEN page_id % 10 = 0 THEN 'error: not UTF-8' ELSE 'ok' END AS status
    FROM pages LEFT JOIN (SELECT path, count(*) AS n FROM {{elements}} GROUP BY path) ON path = page_id""",
)
def parsed_status(spark, sf):
    files_ = parse.decoded(spoiled_files(spark, sf), "path", "content")
    parsed = parse.parsed_documents(parse.parse_elements(files_, "path", "html"), files_)
    items = "cast(variant_get(parsed_content, '$.document.elements') as array<variant>)"
    routed = parse.split_by_status(
        parsed.withColumn("json", F.to_json("parsed_content")).withColumn(
            "error", F.expr("parsed_content:error_status::string")
        ),
        "json",
        "error",
    )
    return routed.select(
        "path",
        F.expr("parsed_content:metadata.size::bigint").alias("size"),
        F.col("error").alias("error_status"),
        F.expr(f"coalesce(size({items}), 0)").cast("bigint").alias("n_elements"),
        "status",
    )


@query("json_string", "SELECT event_id, CAST(json(props) AS VARCHAR) AS props_json FROM events")
def json_string(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.parse_json("props").alias("v"))
    return rows.select("event_id", clean.json_text(rows, "v").alias("props_json"))


@query(
    "quarantine",
    """SELECT event_type, CASE WHEN event_type = 'error' THEN 'corrupt' ELSE 'ok' END AS status,
      count(*) AS n, CAST(sum(CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS INTEGER) END) AS BIGINT) AS sum_k
    FROM events GROUP BY ALL""",
)
def quarantine(spark, sf):
    # Payloads of error events arrive cut short.
    payload = F.when(
        F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")
    ).otherwise(F.col("props"))
    routed = parse.split_by_status(load(spark, sf, "events").withColumn("payload", payload), "payload")
    return routed.groupBy("event_type", "status").agg(
        F.count("*").alias("n"), F.sum(F.try_variant_get("parsed", "$.k", "int")).cast("bigint").alias("sum_k")
    )


@query(
    "doc_metadata",
    """SELECT page_id, regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) AS file_name,
      CAST(strlen(html) AS BIGINT) AS size, 'html' AS format FROM pages""",
)
def doc_metadata(spark, sf):
    return metadata.document_metadata(load(spark, sf, "pages"), "page_id", "url", "html", "html")


@query(
    "enrich_metadata",
    """SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def enrich_metadata(spark, sf):
    return metadata.enrich(load(spark, sf, "documents").select("doc_id", "lang", "source"), load(spark, sf, "labels"), "doc_id")


FIELD_RULES = {
    "title": r"<title>([^<]*)",
    "language": r'<html lang="([^"]*)"',
    "track": r"track\((\d+)\)",
    "first_link": r'href="([^"]*)"',
}


@query(
    "extract_fields",
    """SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)', 1), '') AS title,
      nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS language,
      nullif(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') AS track,
      nullif(regexp_extract(html, 'href="([^"]*)"', 1), '') AS first_link FROM pages""",
)
def extract_fields(spark, sf):
    found = metadata.extract_fields(load(spark, sf, "pages"), "html", FIELD_RULES)
    return found.select("page_id", *[F.expr(f"fields['{f}']").alias(f) for f in FIELD_RULES])


@query("markdown", "SELECT path, markdown FROM {{page_markdown}}")
def markdown(spark, sf):
    return clean.markdown(clean_elements(spark, sf))


@query(
    "prompt",
    f"""SELECT conv_id, turn, '{clean.MARKDOWN_PROMPT.replace("'", "''")}' ||
      CAST(to_json({{'role': role, 'text': text}}) AS VARCHAR) AS prompt FROM conversations""",
)
def prompt(spark, sf):
    body = F.to_json(F.struct("role", "text"))
    return load(spark, sf, "conversations").select("conv_id", "turn", clean.prompt(clean.MARKDOWN_PROMPT, body).alias("prompt"))


@query(
    "plain_text_pages",
    """SELECT conv_id AS path,
      string_agg(text, chr(10) || '== page ==' || chr(10) ORDER BY turn) AS plain_text
    FROM conversations GROUP BY conv_id""",
)
def plain_text_pages(spark, sf):
    return clean.plain_text(turns(spark, sf))


@query(
    "table_markup",
    f"""SELECT page_id AS path, '<table><tr><td>' || cell || '</td></tr></table>' AS content
    FROM (SELECT page_id, regexp_replace(url, '[<>&]', '', 'g') AS cell FROM pages)""",
)
def table_markup(spark, sf):
    # The pages hold no tables, so each gets one with its address.
    cell = F.regexp_replace("url", "[<>&]", "")
    table = F.concat(F.lit("<table><tr><td>"), cell, F.lit("</td></tr></table></article>"))
    pages = load(spark, sf, "pages").withColumn("html", F.replace("html", F.lit("</article>"), table))
    found = parse.keep_types(parse.parse_elements(pages, "page_id", "html"), ["table"])
    return found.select("path", "content")


@query(
    "element_span",
    """SELECT path, page, pos,
      CAST(coalesce(sum(length(content) + 1) OVER (PARTITION BY path, page ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS "start",
      length(content) AS n_chars FROM {{elements}}""",
)
def element_span(spark, sf):
    spans = parse.element_spans(elements(spark, sf))
    return spans.select("path", "page", "pos", "start", (F.col("end") - F.col("start") + 1).alias("n_chars"))


@query(
    "element_descriptions",
    """SELECT path, pos, CASE WHEN type = 'header' THEN 'header of ' || length(content) || ' characters' END AS description
    FROM {{elements}}""",
)
def element_descriptions(spark, sf):
    described = parse.describe_elements(
        elements(spark, sf),
        ["header"],
        lambda kind, content: F.concat(kind, F.lit(" of "), F.length(content).cast("string"), F.lit(" characters")),
    )
    return described.select("path", "pos", "description")


@query("model_map", "SELECT conv_id, turn, upper(substr(text, 1, 1)) || length(text) AS answer FROM conversations")
def model_map(spark, sf):
    def load_model():
        return lambda texts: [t[:1].upper() + str(len(t)) for t in texts]

    return clean.model_map(load(spark, sf, "conversations"), load_model, "text", "answer").select("conv_id", "turn", "answer")


@query("user_parser", "SELECT page_id AS path, strlen(html) AS n_bytes FROM pages")
def user_parser(spark, sf):
    def decode(frames):
        for frame in frames:
            yield frame.assign(n_bytes=frame["content"].map(len))[["path", "n_bytes"]]

    rows = load(spark, sf, "pages").select(F.col("page_id").alias("path"), F.encode("html", "UTF-8").alias("content"))
    return parse.with_user_parser(rows, decode, "path bigint, n_bytes bigint")
