"""Index build, change handling and sync."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from docsift.operators import changes as ch
from docsift.operators import lexical
from docsift.operators.embed import HashedModel
from docsift.plans import index as ix
from docsift.registry.base import load, query, toks, with_parts
from docsift.session import fresh_path, scratch_database
from docsift.sources import files, tables
from docsift.streaming import ingest, sync

_built: dict[tuple[str, str, str], object] = {}


def _name(spark, label: str) -> str:
    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex[:8]}"


def build_documents(spark, sf) -> ix.Index:
    return ix.create_index(
        load(spark, sf, "documents"),
        _name(spark, "documents"),
        "doc_id",
        text_col="text",
        model=HashedModel(),
        filter_columns=["lang", "source", "n_chars"],
        positions=True,
    )


def build_vectors(spark, sf) -> ix.Index:
    return ix.create_index(
        load(spark, sf, "embeddings"),
        _name(spark, "vectors"),
        "vec_id",
        vector_col="embedding",
        filter_columns=["label"],
        n_cells=32,
    )


def once(spark, sf, label, build):
    """What `build` makes is made once per application and data folder, then searched."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _built:
        _built[key] = build(spark, sf)
    return _built[key]


def documents_index(spark, sf) -> ix.Index:
    return once(spark, sf, "documents", build_documents)


def vectors_index(spark, sf) -> ix.Index:
    return once(spark, sf, "vectors", build_vectors)


@query("pk_check", "SELECT source AS key, count(*) AS n FROM documents GROUP BY source HAVING count(*) > 1 OR source IS NULL")
def pk_check(spark, sf):
    return ch.key_faults(load(spark, sf, "documents"), "source")


@query("postings", "SELECT doc_id AS key, term, tf, doc_len FROM {{post}}")
def postings(spark, sf):
    return lexical.postings(load(spark, sf, "documents"), "doc_id", "text").select("key", "term", "tf", "doc_len")


@query(
    "term_stats",
    "SELECT term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM {{freq}}, (SELECT count(*) AS n FROM documents)",
)
def term_stats(spark, sf):
    index = documents_index(spark, sf)
    idf = F.round(lexical.idf(F.lit(index.info["n_docs"]), F.col("df")), 6)
    return index.frequencies().select("term", "df", idf.alias("idf"))


COLUMNS = ["text", "lang", "source", "n_chars"]


def revised(spark, sf):
    """A later state of `documents`: toxic ones gone, line ends turned into blanks,
    benchmark passages added."""
    toxic = load(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    kept = load(spark, sf, "documents").join(toxic, "doc_id", "left_anti").withColumn("text", F.regexp_replace("text", r"\n+", " "))
    added = load(spark, sf, "benchmark").select(
        (-1 - F.col("item_id")).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("bench").alias("source"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    return kept.select("doc_id", *COLUMNS).unionByName(added)


REVISED_SQL = """
    SELECT doc_id, regexp_replace(text, '\\n+', ' ', 'g') AS text, lang, source, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
    UNION ALL SELECT -1 - item_id, text, 'xx', 'bench', length(text) FROM benchmark"""


@query(
    "snapshot_diff",
    f"""SELECT * FROM (SELECT doc_id, CASE WHEN o.n_chars IS NULL THEN 'insert' WHEN r.n_chars IS NULL THEN 'delete'
        WHEN o.text IS DISTINCT FROM r.text OR o.lang IS DISTINCT FROM r.lang OR o.source IS DISTINCT FROM r.source
          OR o.n_chars IS DISTINCT FROM r.n_chars THEN 'update' END AS op, r.text, r.lang, r.source, r.n_chars
      FROM documents o FULL JOIN ({REVISED_SQL}) r USING (doc_id)) WHERE op IS NOT NULL""",
)
def snapshot_diff(spark, sf):
    return ch.snapshot_diff(load(spark, sf, "documents"), revised(spark, sf), "doc_id", COLUMNS)


@query("upsert_delete", REVISED_SQL)
def upsert_delete(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", *COLUMNS)
    return ch.apply_changes(docs, ch.snapshot_diff(docs, revised(spark, sf), "doc_id", COLUMNS), "doc_id")


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def latest_per_key(spark, sf):
    events = load(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return ch.latest_per_key(events, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    "index_managed",
    f"""SELECT count(*) AS n_docs, CAST(sum(len({toks('text')})) AS BIGINT) AS total_len, 64 AS dim,
      'hashed-bag-64' AS model_id FROM documents""",
)
def index_managed(spark, sf):
    return build_documents(spark, sf).describe().select(
        "n_docs", "total_len", F.col("dim").cast("int").alias("dim"), "model_id"
    )


@query(
    "index_describe",
    f"""SELECT 0 AS version, 'doc_id' AS primary_key, 'text' AS text_col, 'hashed-bag-64' AS model_id, 64 AS dim,
      'cosine' AS metric, count(*) AS n_docs, CAST(sum(len({toks('text')})) AS BIGINT) AS total_len,
      'TRIGGERED' AS pipeline_type FROM documents""",
)
def index_describe(spark, sf):
    index = documents_index(spark, sf)
    return ix.get_index(spark, index.name).describe().drop("name", "n_cells")


@query(
    "model_mismatch",
    """SELECT 'hashed-bag-64' AS model_id, count(*) AS n_docs,
      'index was built with model ''hashed-bag-64'', not ''hashed-bag-32''' AS refusal FROM documents""",
)
def model_mismatch(spark, sf):
    index = documents_index(spark, sf)
    try:
        ix.get_index(spark, index.name, HashedModel(32))
        refusal = None
    except ValueError as error:
        refusal = str(error)
    return index.describe().select("model_id", "n_docs", F.lit(refusal).alias("refusal"))


@query("index_drop", "SELECT count(*) AS n_source, count(*) AS n_docs, true AS existed, true AS gone FROM pages")
def index_drop(spark, sf):
    index = ix.create_index(load(spark, sf, "pages"), _name(spark, "pages"), "page_id", text_col="html")
    shown = index.describe().select("n_docs").first()[0]
    existed = ix.index_exists(spark, index.name)
    gone = ix.drop_index(spark, index.name)
    return load(spark, sf, "pages").agg(
        F.count("*").alias("n_source"), F.lit(shown).alias("n_docs"), F.lit(existed).alias("existed"), F.lit(gone).alias("gone")
    )


LIVE_SQL = f"SELECT doc_id, lang, source, n_chars, CAST(len({toks('text')}) AS BIGINT) AS doc_len FROM ({REVISED_SQL})"


def _live(index: ix.Index):
    return index.live("rows").select("doc_id", "lang", "source", "n_chars", F.col("_doc_len").alias("doc_len"))


@query("index_sync", LIVE_SQL)
def index_sync(spark, sf):
    table = f"{scratch_database(spark)}.synced_documents"
    tables.drop(spark, table)
    tables.register_parquet(spark, table, f"{sf}/documents.parquet")
    tables.enable_change_feed(spark, table)
    index = ix.create_index(
        spark.table(table), _name(spark, "synced"), "doc_id", text_col="text", model=HashedModel(), source_table=table
    )
    return _live(ix.sync(index, revised(spark, sf)))


def build_revised(spark, sf) -> ix.Index:
    """An index over `documents`, brought to their later state."""
    docs = load(spark, sf, "documents")
    index = ix.create_index(docs, _name(spark, "revised"), "doc_id", text_col="text", model=HashedModel(), positions=True)
    return ix.sync(index, revised(spark, sf))


def revised_index(spark, sf) -> ix.Index:
    return once(spark, sf, "revised", build_revised)


def on_revised(sql: str) -> str:
    """SQL over `documents`, asked of their later state instead."""
    whole = re.sub(r"\bdocuments\b", "later", with_parts(sql)).strip()
    rest = whole[4:] if whole.startswith("WITH") else f" {whole}"
    return f"WITH later AS ({REVISED_SQL}){',' if whole.startswith('WITH') else ''}{rest}"


@query("index_replica", LIVE_SQL)
def index_replica(spark, sf):
    """An index brought to the state of another one: only the ranges of keys where their digests differ are read."""
    docs = load(spark, sf, "documents")
    copy = ix.create_index(docs, _name(spark, "replica"), "doc_id", text_col="text", positions=True)
    return _live(ix.sync(copy, revised_index(spark, sf)))


@query("index_stream_sync", LIVE_SQL)
def index_stream_sync(spark, sf):
    docs = load(spark, sf, "documents")
    index = ix.create_index(docs, _name(spark, "streamed"), "doc_id", text_col="text", pipeline_type="CONTINUOUS")
    diff = ch.snapshot_diff(docs, revised(spark, sf), "doc_id", COLUMNS).withColumn("seq", F.lit(1))
    inbox = fresh_path(spark, "inbox")
    diff.repartition(2, "doc_id").write.parquet(inbox)
    stream = ingest.file_stream(spark, inbox, diff.schema, files_per_trigger=1)
    sync.continuous_sync(index, stream, ["seq"], fresh_path(spark, "progress"), once=True).awaitTermination()
    return _live(index)


@query(
    "stream_late_changes",
    """SELECT user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""",
)
def stream_late_changes(spark, sf):
    """The last event of every user, from a stream that brings the later half first."""
    events = load(spark, sf, "events").select("user_id", "event_type", "value", "event_id")
    start = events.select("user_id").distinct().selectExpr("user_id", "'none' AS event_type", "0.0D AS value")
    index = ix.create_index(start, _name(spark, "late"), "user_id", text_col="event_type", pipeline_type="CONTINUOUS")
    changes = events.withColumn("op", F.lit("update"))
    middle = events.agg(F.expr("percentile(event_id, 0.5)")).first()[0]
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    for part in (F.col("event_id") > middle, F.col("event_id") <= middle):
        changes.filter(part).write.mode("append").parquet(inbox)
        stream = ingest.file_stream(spark, inbox, changes.schema)
        sync.continuous_sync(index, stream, ["event_id"], progress, once=True).awaitTermination()
    return index.live("rows").select("user_id", "event_type", "value")


@query("ingest_parsed", "SELECT path, page, pos, type, region, level, content FROM {{elements}}")
def ingest_parsed(spark, sf):
    """Pages as files of bytes, streamed into the parser some at a time."""
    inbox, target = fresh_path(spark, "inbox"), fresh_path(spark, "ingested")
    pages = load(spark, sf, "pages").select("page_id", "html")
    n_files = files.write_texts(pages, "page_id", "html", inbox, "page_id=")
    some = min(max(1, -(-n_files // 2)), 100_000)
    ingest.ingest_parsed(spark, inbox, target, fresh_path(spark, "progress"), "*.txt", some)
    elements = spark.read.parquet(f"{target}/elements")
    page = F.regexp_extract("path", r"page_id=(-?\d+)", 1).try_cast("bigint")
    return elements.select(page.alias("path"), "page", "pos", "type", "region", "level", "content")


@query("ingest_stream", "SELECT event_id, user_id, event_type, value FROM events")
def ingest_stream(spark, sf):
    source = f"{sf}/events.parquet"
    one_or_many = f"{sf}/events.parque[t]"  # a glob serves a single file and a folder alike
    schema = spark.read.parquet(source).schema
    target = fresh_path(spark, "ingested")
    ingest.ingest(ingest.file_stream(spark, one_or_many, schema), target, fresh_path(spark, "progress"))
    return spark.read.schema(schema).parquet(target).select("event_id", "user_id", "event_type", "value")
