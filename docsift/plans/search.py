"""Similarity, keyword and hybrid search for whole tables of queries.

filter -> score on narrow tables -> k best per query -> (fuse) -> (rerank)
-> fetch the requested columns of the winners.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators import cells as ivf
from docsift.operators import lexical
from docsift.operators import rank
from docsift.operators import topk
from docsift.plans import filters as flt
from docsift.plans.index import Index, _shard, require_model
from docsift.session import BROADCAST_ROWS, small_side, written

SIMILARITY, HYBRID, FULL_TEXT = "SIMILARITY", "HYBRID", "FULL_TEXT"
BROADCAST_HITS = 500_000
TERMS_PER_QUERY = 100
FEW_KEYS = 1000


@dataclass(frozen=True)
class SearchSpec:
    """What to return and how.

    `num_results` hits per query; `query_type` None, "hybrid" or "FULL_TEXT" in any
    case; `filters` maps "column OP" to a value; a `reranker` re-scores the first
    `candidates` hits. Hybrid search fuses the first `fusion_depth` hits of each list,
    which the caller states. `nprobe` bounds the cells that a vector search visits
    (None: all vectors, exact); it needs an index with cells. `grants` holds the values of
    `grant_column` the caller may see; with a column `caller` as well, each query sees what
    its own `caller` may (similarity search without `nprobe`).
    """

    columns: tuple[str, ...]
    num_results: int
    query_type: str | None = None
    filters: Mapping[str, object] | None = None
    reranker: object | None = None
    candidates: int = 50
    fusion_depth: int | None = None
    nprobe: int | None = None
    grants: DataFrame | None = None
    grant_column: str | None = None

    @property
    def mode(self) -> str:
        mode = (self.query_type or SIMILARITY).upper()
        if mode not in (SIMILARITY, HYBRID, FULL_TEXT):
            raise ValueError(f"unknown query type {self.query_type!r}")
        return mode


def _allowed(index: Index, part: str, spec: SearchSpec) -> DataFrame:
    """A narrow table cut to the rows the filters and grants let through.

    Columns kept beside the vectors and postings are tested in the scan; others
    are looked up in the row table by key.
    """
    table = index.live(part)
    info = index.info
    test = flt.predicate(spec.filters, info["columns"])
    asked = flt.columns_of(spec.filters) + ([spec.grant_column] if spec.grants is not None else [])
    if set(asked) <= set(info["filter_columns"]):
        return _granted(table if test is None else table.filter(test), spec)
    rows = index.live("rows")
    rows = _granted(rows if test is None else rows.filter(test), spec)
    keys = rows.select(F.col(info["primary_key"]).alias("key"))
    n = keys.limit(BROADCAST_ROWS + 1).count()
    return table.join(small_side(keys, n), "key", "left_semi")


def _by_caller(spec: SearchSpec) -> bool:
    return spec.grants is not None and "caller" in spec.grants.columns


def _granted(table: DataFrame, spec: SearchSpec) -> DataFrame:
    if spec.grants is None or _by_caller(spec):
        return table
    return table.join(spec.grants.select(spec.grant_column), spec.grant_column, "left_semi")


def similar(index: Index, queries: DataFrame, spec: SearchSpec, k: int) -> DataFrame:
    """`query_id, key, score, rank` by vector; queries bring a `vector` or a text."""
    if "vector" in queries.columns:
        asked = queries.select("query_id", "vector")
    else:
        if index.model is None:
            raise ValueError("this index has no text model; pass query vectors")
        asked = queries.select("query_id", index.model.column(F.col("query_text")).alias("vector"))
    vectors = _allowed(index, "vectors", spec)
    if _by_caller(spec):
        if spec.nprobe is not None or spec.grant_column not in vectors.columns:
            raise ValueError("grants by caller need the grant column among the filter columns, and no nprobe")
        value = F.xxhash64(F.col(spec.grant_column).cast("string"))
        seen = spec.grants.groupBy("caller").agg(F.collect_set(value).alias("bands"))
        asked = asked.join(queries.select("query_id", "caller"), "query_id").join(seen, "caller")
        vectors = vectors.withColumn("bands", F.array(value))
    dim = index.info["dim"]
    wrong = asked.filter(F.size("vector") != dim).limit(1).collect() if "vector" in queries.columns else []
    if wrong:
        raise ValueError(f"query {wrong[0]['query_id']} has not {dim} numbers as the index has")
    approximate = spec.nprobe is not None
    if approximate and index.centres is None:
        raise ValueError("nprobe asks for cells, which this index does not have")
    if approximate:
        metric = index.info["metric"]
        probes = ivf.nearest_cells(F.col("vector"), index.centres, spec.nprobe, metric)
        asked = asked.withColumn("probes", probes)
    within = "cells" if approximate else "bands" if _by_caller(spec) else None
    return topk.nearest(vectors, asked, k, index.info["metric"], within=within)


def keyword(index: Index, queries: DataFrame, spec: SearchSpec, k: int) -> DataFrame:
    """`query_id, key, score, rank` by BM25."""
    if _by_caller(spec):
        raise ValueError("grants by caller are for similarity search")
    terms = lexical.query_terms(queries, "query_text")
    weighted = lexical.weighted_queries(terms, index.frequencies(), index.info["n_docs"])
    return topk.bm25(_allowed(index, "postings", spec), weighted, k, index.avg_len)


def candidates(index: Index, queries: DataFrame, spec: SearchSpec, k: int) -> DataFrame:
    if spec.mode == FULL_TEXT:
        return keyword(index, queries, spec, k)
    if spec.mode == SIMILARITY:
        return similar(index, queries, spec, k)
    if spec.fusion_depth is None:
        raise ValueError("hybrid search needs a fusion_depth: how many hits of each list are fused")
    depth = max(k, spec.fusion_depth)
    return rank.fuse(similar(index, queries, spec, depth), keyword(index, queries, spec, depth), k)


def fetch(index: Index, hits: DataFrame, columns: tuple[str, ...] | list[str], small: bool) -> DataFrame:
    """Add columns of the hit rows.

    When the row table has several shards and the hits are few, they are written
    first, and only their shards are read - only their row groups for a handful.
    """
    info = index.info
    key = info["primary_key"]
    unknown = [c for c in columns if c not in info["columns"]]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    extra = [c for c in columns if c != key]
    if not extra:
        return hits
    rows = index.live("rows")
    if small and info["n_shards"] > 1:
        hits = written(index.spark, hits, "hits")
        shards = hits.select(_shard(index, F.col("key"))).distinct().limit(info["n_shards"]).collect()
        rows = rows.filter(F.col("_shard").isin([r[0] for r in shards]))
        keys = hits.select("key").distinct().limit(FEW_KEYS + 1).collect()
        if len(keys) <= FEW_KEYS:
            rows = rows.filter(F.col(key).isin([r[0] for r in keys]))
    rows = rows.select(F.col(key).alias("_pk"), *[F.col(c).alias(f"_c_{c}") for c in extra])
    side = F.broadcast(hits) if small else hits
    joined = rows.join(side, rows["_pk"] == side["key"])
    return joined.select(*hits.columns, *[F.col(f"_c_{c}").alias(c) for c in extra])


def _is_small(queries: DataFrame, per_query: int) -> bool:
    most = max(1, BROADCAST_HITS // max(per_query, 1))
    return queries.limit(most + 1).count() <= most


def search(index: Index, queries: DataFrame, spec: SearchSpec, model=None) -> DataFrame:
    """`query_id, rank, score, <primary key>, <columns>` for each row of
    `queries(query_id, query_text | vector)`."""
    require_model(index.info, model)
    if model is not None:
        index = replace(index, model=model)
    k = spec.num_results
    depth = k if spec.reranker is None else max(k, spec.candidates)
    small = _is_small(queries, depth)
    hits = candidates(index, queries, spec, depth)
    columns = list(spec.columns)
    if spec.reranker is not None:
        needed = [c for c in spec.reranker.columns_to_rerank if c not in columns]
        texts = fetch(index, hits.drop("score", "rank"), columns + needed, small)
        asked = queries.select("query_id", "query_text")
        pairs = texts.join(F.broadcast(asked) if small else asked, "query_id")
        # Hits sit in the few partitions they were read from; scoring is spread evenly.
        pairs = pairs.repartition("query_id", "key")
        found = topk.rank_hits(spec.reranker.score(pairs), k)
    else:
        found = fetch(index, hits, columns, small)
    key = index.info["primary_key"]
    shown = [c for c in columns if c != key]
    return found.select("query_id", "rank", "score", F.col("key").alias(key), *shown)


def similarity_search(
    index: Index,
    query_text: str,
    columns: list[str],
    num_results: int,
    query_type: str | None = None,
    filters: Mapping[str, object] | None = None,
    reranker=None,
    **more,
) -> DataFrame:
    """Search for one text, given as a string."""
    one = index.spark.createDataFrame([(0, query_text)], "query_id bigint, query_text string")
    spec = SearchSpec(tuple(columns), num_results, query_type, filters, reranker, **more)
    return search(index, one, spec).drop("query_id")


def match_all_terms(
    index: Index,
    queries: DataFrame,
    filters: Mapping[str, object] | None = None,
    grants: DataFrame | None = None,
    grant_column: str | None = None,
) -> DataFrame:
    """Every document that holds all distinct tokens of a query, among those that filters and
    grants let through: a filter, not a ranking."""
    small = _is_small(queries, TERMS_PER_QUERY)
    spec = SearchSpec((), 0, FULL_TEXT, filters, grants=grants, grant_column=grant_column)
    return lexical.all_terms(_allowed(index, "postings", spec), index.frequencies(), queries, "query_text", small)


def match_phrase(
    index: Index,
    queries: DataFrame,
    filters: Mapping[str, object] | None = None,
    grants: DataFrame | None = None,
    grant_column: str | None = None,
) -> DataFrame:
    """Every document that holds the tokens of a query in a row, with how often and where first, among those that
    filters and grants let through. The index must have been built with positions; texts are not read."""
    if not index.info["positions"]:
        raise ValueError("phrase search needs an index with positions")
    small = _is_small(queries, TERMS_PER_QUERY)
    spec = SearchSpec((), 0, FULL_TEXT, filters, grants=grants, grant_column=grant_column)
    return lexical.phrases(_allowed(index, "postings", spec), index.frequencies(), queries, "query_text", small)


def parents(chunk_hits: DataFrame, owners: DataFrame, k: int) -> DataFrame:
    """Best k parent documents by their best chunk; `owners(key, parent)`."""
    best = (
        chunk_hits.join(owners, "key")
        .groupBy("query_id", F.col("parent").alias("key"))
        .agg(F.max("score").alias("score"))
    )
    return topk.rank_hits(best, k)
