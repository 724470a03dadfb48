"""The registered queries against their SQL, and the pipeline."""

import corpus_pipeline
import pytest
from check import connect
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_hits
from test_line_templates import brute as brute_lines
from test_near_duplicates import brute as brute_groups

import __spark_entry__
from docsift.llm import bpe, store
from docsift.llm.queries import ORACLES, QUERIES, vocabulary

COLUMNS = {
    1: "doc_id start n_tokens ids_crc32", 2: "page_id url text n_chars", 3: "doc_id n_shingles component_id kept",
    4: "doc_id held_out lang_pred score", 5: "doc_id n_lines n_dropped text", 6: "query_id rank vec_id score",
    7: "doc_id held_out score predicted", 8: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    9: "doc_id n_words n_hit n_items items_sha256 contaminated", 10: "doc_id n_tokens ids_sha256 decoded_sha256",
    11: "vec_id code error label_error codebooks_sha256",
    12: "doc_id size source_size target taken", 13: "word form root n n_near form_n",
}


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in COLUMNS:
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    got = QUERIES[name](spark, sf)
    sql = connect(sf).sql(ORACLES[name])
    columns = COLUMNS[int(name[2:].split("_")[0])].split()
    assert got.columns == columns and sorted(sql.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, sql.select(", ".join(columns)).fetchall()))


def test_pipeline_stages(spark, sf):
    """Each stage against a plain version of its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns, rows = docs.columns, [(r["doc_id"], r["text"]) for r in docs.collect()]
    bad = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = store.keep(spark, stage(spark, docs, sf), "test-stage")
        assert docs.columns == columns
        left = {r["doc_id"]: r["text"] for r in docs.collect()}
        if i == 0:
            assert len(bad & left.keys()) <= 0.05 * len(bad) and len(good - left.keys()) <= 0.02 * len(good)
            assert all(left[d] == t for d, t in rows if d in left)
        if i == 1:
            expected = brute_lines(rows, short=1)
            assert left == {d: t for d, (t, n, dropped) in expected.items() if not (dropped and dropped == n)}
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if i == 2:
            assert left.keys() == {d for d, _, _, kept in brute_groups(rows, 5, 80) if kept}
        if i == 3:
            assert left.keys() == {d for d, n, hit, _ in brute_hits(rows, items) if not (hit and 20 * hit >= n)}
        rows = list(left.items())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    decoded = bpe.decode(out, vocabulary("byte_bpe_50k.tiktoken")).collect()
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in decoded} == dict(rows)


def test_pipeline_of_nothing(spark, sf):
    empty = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_passes_columns_of_any_name_and_odd_rows(spark, sf):
    """Nulls, repeated ids, ties and clashing names through every stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    names = {f"{n}": 1 for n in ("a.b", "__items", "__lines", "__of", "__blank", "c0", "gone")}
    odd = docs.limit(1).withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    none = docs.limit(1).withColumn("text", F.lit(None).cast("string"))
    docs = docs.unionByName(docs.limit(5)).unionByName(odd).unionByName(none)
    docs = store.keep(spark, docs.select("*", *(F.lit(v).alias(k) for k, v in names.items())), "test-odd")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = store.keep(spark, stage(spark, docs, sf), "test-odd")
        assert left.columns == docs.columns and 0 < left.count() <= docs.count()
        docs = left
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
