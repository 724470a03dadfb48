"""A search index as managed catalog tables.

`<name>__rows`      synced columns, split by key hash so that hits are fetched
                    from a few partitions
`<name>__vectors`   key, vector, cell, filter columns; split by cell
`<name>__postings`  key, term, tf, doc_len, filter columns, positions if asked for; bucketed by
                    key and sorted by term: scoring meets per document without a shuffle
`<name>__terms`     term, df as signed increments
`<name>__centres`   cell centres
`<name>__changed`   keys touched by each sync
`<name>__digests`   the tree of digests over the rows, as signed increments
`<name>__orders`    the order value that each key of a stream has reached

Every table carries `_seg`. The build writes segment 0, each sync one more with
the changed rows only, under a number not used before. The property on
`<name>__rows` that lists the committed segments is set last: a reader sees whole
segments, and what a failed sync left behind is never read. A row is live when no
later segment has touched its key. One writer at a time; `compact` merges
segments.

A sync compares digest trees first (`operators.digests`) and then reads only the ranges
of keys that differ: of the index, the row shards that hold them. What a changed row takes away - its
terms, its length, its mark - follows from the old row; postings and vectors are not read.
"""

from __future__ import annotations

import json
import math
import time
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators import cells as ivf
from docsift.operators import changes as ch
from docsift.operators import digests as dg
from docsift.operators import lexical
from docsift.operators.embed import HashedModel, vector_report
from docsift.operators.topk import LOWER_IS_BETTER
from docsift.functions import tokens as tk
from docsift.session import counted, small_side, written
from docsift.sources import tables

PARTS = ("rows", "vectors", "postings", "terms", "centres", "changed", "digests", "orders")
ROWS_PER_SHARD = 2_000_000
DOCS_PER_BUCKET, MIN_BUCKETS = 10_000, 8
PROPERTY = "docsift.index"
#: Filter columns that Arrow writes to Parquet as Spark does.
_PLAIN = (T.IntegralType, T.StringType, T.BooleanType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
_RESERVED = {"key", "term", "tf", "df", "doc_len", "positions", "vector", "cell"}


@dataclass
class Index:
    spark: SparkSession
    name: str
    info: dict
    model: object | None = None
    centres: np.ndarray | None = field(default=None, repr=False)

    def table(self, part: str) -> str:
        return f"{self.name}__{part}"

    @property
    def version(self) -> int:
        return len(self.info["segments"]) - 1

    @property
    def avg_len(self) -> float:
        return self.info["total_len"] / max(self.info["n_docs"], 1)

    def committed(self, part: str) -> DataFrame:
        return self.spark.table(self.table(part)).filter(F.col("_seg").isin(self.info["segments"]))

    def live(self, part: str) -> DataFrame:
        """Rows of a part that no later segment has replaced or removed."""
        rows = self.committed(part)
        if self.version == 0:
            return rows
        key = self.info["primary_key"] if part == "rows" else "key"
        touched = self.committed("changed").groupBy(F.col("key").alias("_k")).agg(F.max("_seg").alias("_upto"))
        touched = small_side(touched, self.info["n_changed"])
        return rows.join(touched, (rows[key] == touched["_k"]) & (rows["_seg"] < touched["_upto"]), "left_anti")

    def frequencies(self) -> DataFrame:
        terms = self.committed("terms")
        if self.version == 0:
            return terms.select("term", "df")
        return terms.groupBy("term").agg(F.sum("df").alias("df")).filter(F.col("df") > 0)

    def describe(self) -> DataFrame:
        """One row: counts, dimension, model, metric, version."""
        shown = {
            "name": self.name,
            "version": self.version,
            **{k: self.info[k] for k in ("primary_key", "text_col", "model_id", "dim", "metric")},
            **{k: self.info[k] for k in ("n_docs", "total_len", "n_cells", "pipeline_type")},
        }
        kinds = {int: "bigint", str: "string", type(None): "string"}
        schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in shown.items())
        return self.spark.createDataFrame([tuple(shown.values())], schema)


def _save_info(index: Index) -> None:
    value = json.dumps(index.info).replace("\\", "\\\\").replace("'", "\\'")
    index.spark.sql(f"ALTER TABLE {index.table('rows')} SET TBLPROPERTIES ('{PROPERTY}' = '{value}')")


def _append(
    index: Index, df: DataFrame, part: str, seg: int, split: str | None = None, buckets: int | None = None, files: tuple[str, list[str]] | None = None
) -> None:
    """Add `df` to a part. `files`, a side folder of the table and names in it, hold the rows of `df` already and become the table's."""
    if files:
        tables.adopt(index.spark, index.table(part), f"_seg={seg}", *files)
        return
    writer = df.withColumn("_seg", F.lit(seg).cast("bigint")).write.format("parquet").mode("append")
    writer = writer.partitionBy("_seg", split) if split else writer.partitionBy("_seg")
    if buckets:
        writer = writer.bucketBy(buckets, "key").sortBy("term")
    writer.saveAsTable(index.table(part))


def _leaf(index: Index, key) -> object:
    return dg.leaf_of(key, index.info["n_leaves"])


def _shard_of_leaf(index: Index, leaf) -> object:
    """Shards are ranges of leaves."""
    return F.floor(leaf * index.info["n_shards"] / index.info["n_leaves"]).cast("int")


def _shard(index: Index, key) -> object:
    return _shard_of_leaf(index, _leaf(index, key))


def _in_shards(index: Index, rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """`rows` of the shards of `leaves(node)` only: the others are not read."""
    n = index.info["n_shards"]
    if n == 1:
        return rows
    shards = leaves.select(_shard_of_leaf(index, F.col("node")).alias("s")).distinct().limit(n).collect()
    return rows if len(shards) == n else rows.filter(F.col("_shard").isin([r["s"] for r in shards]))


def _write_rows(index: Index, source: DataFrame, seg: int) -> None:
    info = index.info
    length = F.size(tk.tokens(F.col(info["text_col"]))) if info["text_col"] else F.lit(0)
    rows = source.select(*info["columns"])
    rows = rows.withColumns(
        {
            "_doc_len": length.cast("bigint"),
            "_mark": dg.mark_of(rows, info["primary_key"], info["columns"]),
            "_shard": _shard(index, F.col(info["primary_key"])),
        }
    )
    if info["n_shards"] > 1:
        rows = rows.hint("rebalance", F.col("_shard")).sortWithinPartitions("_shard", info["primary_key"])
    _append(index, rows, "rows", seg, split="_shard")


def _write_postings(index: Index, source: DataFrame, seg: int, n_rows: int) -> DataFrame:
    """Write postings and return their `term, df` in parts. A task writes whole buckets, and no more tasks run than the rows need."""
    info, spark, table = index.info, index.spark, index.table("postings")
    buckets = info["n_buckets"]
    tasks = min(buckets, max(1, math.ceil(n_rows / DOCS_PER_BUCKET) * MIN_BUCKETS))
    what = source, info["primary_key"], info["text_col"], info["filter_columns"]
    by = F.col("key") if tasks == buckets else F.pmod(F.hash("key"), F.lit(buckets))
    posts = lexical.postings(*what, tasks, info["positions"], by)
    if not spark.catalog.tableExists(table):
        _append(index, posts.limit(0), "postings", seg, buckets=buckets)
    plain = all(isinstance(source.schema[c].dataType, _PLAIN) for c in info["filter_columns"])
    folder = tables.side_folder(spark, table) if plain else None
    if folder is None:
        _append(index, posts, "postings", seg, buckets=buckets)
        return lexical.frequency_parts(source, info["text_col"], F.lit(1))
    found, schema = lexical.posting_files(*what, folder, buckets, tasks, info["positions"])
    found = written(spark, found, "posting-files")
    names = [r["file"] for r in found.filter("file IS NOT NULL").select("file").collect()]  # one row a file, of some MB of text
    paths = [f"{folder}/{name}" for name in names]
    rows = spark.read.schema(schema).parquet(*paths) if paths else posts.limit(0)
    _append(index, rows, "postings", seg, buckets=buckets, files=(folder, names))
    return found.filter("file IS NULL").select("term", "df")


def _write_digests(index: Index, signed: DataFrame, seg: int) -> None:
    """Add `signed(node, n, mark)` of leaves to the tree."""
    _append(index, dg.levels(signed).coalesce(1 if index.info["n_leaves"] < 100_000 else 8), "digests", seg, split="level")


def _vector_rows(index: Index, source: DataFrame) -> DataFrame:
    info = index.info
    vector = F.col(info["vector_col"]) if info["vector_col"] else index.model.column(F.col(info["text_col"]))
    return source.select(F.col(info["primary_key"]).alias("key"), vector.alias("vector"), *info["filter_columns"])


def _write_vectors(index: Index, vectors: DataFrame, seg: int) -> None:
    if index.centres is not None:
        # Few files per cell; adaptive execution splits a heavy cell over tasks.
        vectors = vectors.withColumn("cell", ivf.cell_of(F.col("vector"), index.centres, index.info["metric"]))
        vectors = vectors.hint("rebalance", F.col("cell"))
    else:
        vectors = vectors.withColumn("cell", F.lit(0))
    _append(index, vectors, "vectors", seg, split="cell")


def create_index(
    source: DataFrame,
    name: str,
    primary_key: str,
    text_col: str | None = None,
    model=None,
    vector_col: str | None = None,
    columns: list[str] | None = None,
    filter_columns: list[str] | None = None,
    n_cells: int | None = None,
    metric: str = "cosine",
    pipeline_type: str = "TRIGGERED",
    source_table: str | None = None,
    positions: bool = False,
) -> Index:
    """Build and commit an index over `source`.

    Give `text_col` and a `model` to have vectors computed, `vector_col` to use
    your own, or `text_col` alone for keyword search. `columns` are synced (all by
    default); `filter_columns` are also kept beside vectors and postings, so that
    filters on them act in the scan. With `source_table`, that table must have its
    change feed on. With `positions`, postings say where a term stands, for phrase search.
    """
    spark = source.sparkSession
    columns = list(columns or source.columns)
    filter_columns = list(filter_columns or [])
    needed = [primary_key] + [c for c in (text_col, vector_col) if c] + filter_columns
    columns += [c for c in needed if c not in columns]
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    if _RESERVED & set(filter_columns):
        raise ValueError(f"filter columns may not be named {sorted(_RESERVED)}")
    if text_col and not isinstance(source.schema[text_col].dataType, T.StringType):
        raise ValueError(f"text column {text_col} must be a string")
    if not text_col and not vector_col:
        raise ValueError("give a text column, a vector column, or both")
    if metric not in LOWER_IS_BETTER:
        raise ValueError(f"unknown metric {metric!r}")
    if not isinstance(source.schema[primary_key].dataType, (T.IntegralType, T.StringType)):
        raise ValueError(f"{primary_key} must be a whole number or a string")
    if pipeline_type not in ("TRIGGERED", "CONTINUOUS"):
        raise ValueError(f"unknown pipeline type {pipeline_type!r}")
    if source_table:
        tables.require_change_feed(spark, source_table)
    if index_exists(spark, name):
        raise ValueError(f"index {name} exists")
    n = ch.require_key(source, primary_key)
    info = {
        "segments": [0],
        "primary_key": primary_key,
        "text_col": text_col,
        "vector_col": vector_col,
        "columns": columns,
        "filter_columns": filter_columns,
        "source_table": source_table,
        "pipeline_type": pipeline_type,
        "metric": metric,
        "model_id": None if vector_col else getattr(model, "model_id", None),
        "dim": None,
        "n_docs": n,
        "n_changed": 0,
        "total_len": 0,
        "n_cells": 0,
        "n_shards": max(1, math.ceil(n / ROWS_PER_SHARD)),
        "n_buckets": max(MIN_BUCKETS, math.ceil(n / DOCS_PER_BUCKET)),
        "n_leaves": dg.leaf_count(n),
        "positions": positions,
        "streams": {},
    }
    index = Index(spark, name, info, model)
    _clear(index)
    _write_rows(index, source, 0)
    # From here on the stored rows are read, so a costly source is not computed again.
    stored = spark.table(index.table("rows"))
    _write_digests(index, dg.leaves(stored, _leaf(index, F.col(primary_key)), "_mark"), 0)
    if text_col:
        info["total_len"] = int(stored.agg(F.sum("_doc_len")).first()[0] or 0)
        _append(index, lexical.summed(_write_postings(index, stored, 0, n)), "terms", 0)
    if vector_col or model:
        vectors = written(spark, _vector_rows(index, stored), "vectors")
        first = vectors.select(F.size("vector")).first()
        info["dim"] = int(first[0]) if first else getattr(model, "dim", 0)
        _require_vectors(vectors, info["dim"])
        wanted = min(n, ivf.cell_count(n) if n_cells is None else n_cells)
        if wanted > 1:
            index.centres = ivf.train_cells(ivf.training_rows(vectors, "key", n, wanted), "vector", wanted, metric)
            info["n_cells"] = len(index.centres)
            rows = [(i, [float(x) for x in c]) for i, c in enumerate(index.centres)]
            _append(index, spark.createDataFrame(rows, "cell int, centre array<double>"), "centres", 0)
        _write_vectors(index, vectors, 0)
    key_type = source.schema[primary_key].dataType.simpleString()
    _append(index, spark.createDataFrame([], f"key {key_type}"), "changed", 0)
    _save_info(index)
    return index


def _require_vectors(vectors: DataFrame, dim: int) -> None:
    bad = vector_report(vectors, "key", "vector", dim).filter(~F.col("ok")).limit(3).collect()
    if bad:
        raise ValueError(f"not vectors of {dim} numbers, keys: {[r['key'] for r in bad]}")


def _clear(index: Index) -> None:
    for part in PARTS:
        tables.drop(index.spark, index.table(part))


def index_exists(spark: SparkSession, name: str) -> bool:
    table = f"{name}__rows"
    return spark.catalog.tableExists(table) and PROPERTY in tables.properties(spark, table)


def get_index(spark: SparkSession, name: str, model=None) -> Index:
    """Open a committed index. The model must be the one the index was built with;
    the built-in one is found by its id."""
    if not index_exists(spark, name):
        raise ValueError(f"no index {name}")
    info = json.loads(tables.properties(spark, f"{name}__rows")[PROPERTY])
    built_with = info["model_id"]
    if model is None and built_with == HashedModel(info["dim"] or 1).model_id:
        model = HashedModel(info["dim"])
    require_model(info, model)
    index = Index(spark, name, info, model)
    if info["n_cells"]:
        rows = index.committed("centres").orderBy("cell").collect()  # one row a cell
        index.centres = np.array([r["centre"] for r in rows])
    return index


def require_model(info: dict, model) -> None:
    """Documents and queries must be embedded by one model."""
    if model is not None and info["model_id"] is not None and model.model_id != info["model_id"]:
        raise ValueError(f"index was built with model {info['model_id']!r}, not {model.model_id!r}")


def drop_index(spark: SparkSession, name: str) -> bool:
    """Remove all tables of the index; True when it is gone."""
    for part in PARTS[1:] + PARTS[:1]:
        tables.drop(spark, f"{name}__{part}")
    return not index_exists(spark, name)


def _next_segment(index: Index) -> int:
    """Above all committed ones, and not the number of an attempt that failed."""
    return max(index.info["segments"][-1] + 1, time.time_ns() // 1000)


def _newer(index: Index, changes: DataFrame, stream: str, order: list[str]) -> DataFrame:
    """Changes above the order value that their key has reached in this stream."""
    rows = changes.withColumn("_order", F.struct(*order))
    if not index.spark.catalog.tableExists(index.table("orders")):
        return rows
    key = index.info["primary_key"]
    reached = index.committed("orders").filter(F.col("stream") == stream)
    reached = reached.join(rows.select(F.col(key).alias("key")), "key", "left_semi")
    reached = reached.groupBy(F.col("key").alias(key)).agg(F.max("reached").alias("_reached"))
    rows = rows.join(reached, key, "left")
    return rows.filter(F.col("_reached").isNull() | (F.col("_order") > F.col("_reached"))).drop("_reached")


def apply_changes(
    index: Index,
    changes: DataFrame,
    stream: str | None = None,
    batch: int | None = None,
    order: list[str] | None = None,
) -> Index:
    """Commit `changes` (primary key, `op`, synced columns; one row per key).

    `op` is 'delete', anything else puts the row. Work is in proportion to the
    changes: only their rows are embedded, tokenised and written. A batch number
    already committed for the same `stream` is skipped. With `order`, the columns that
    order the changes of a key, one that is not above what the key has reached in the
    stream is passed over, in whichever batch it comes; deletes count as well.
    """
    info, spark = index.info, index.spark
    if stream is not None and batch is not None and batch <= info["streams"].get(stream, -1):
        return index
    key = info["primary_key"]
    ordered = ["_order"] if order else []
    if order:
        changes = _newer(index, changes, stream or "", order)
    changes = _typed(index, changes)
    batch_rows, n_changed = counted(spark, changes.select("op", *info["columns"], *ordered), "changes")
    if n_changed == 0:
        if stream is not None:
            info["streams"][stream] = batch
            _save_info(index)
        return index
    ch.require_key(batch_rows, key)
    seg = _next_segment(index)
    touched = batch_rows.select(F.col(key).alias("key"))
    few = small_side(touched, n_changed)
    puts = batch_rows.filter(F.col("op") != "delete")
    # The rows that the changes replace, from their shards alone.
    old = _in_shards(index, index.live("rows"), touched.select(_leaf(index, F.col("key")).alias("node")))
    text = [info["text_col"]] if info["text_col"] else []
    old = old.join(few, F.col(key) == few["key"], "left_semi").select(key, "_doc_len", "_mark", *text)
    gone, n_gone = counted(spark, old, "replaced")
    len_gone = gone.agg(F.coalesce(F.sum("_doc_len"), F.lit(0))).first()[0]
    _write_rows(index, puts, seg)
    new_rows = spark.table(index.table("rows")).filter(F.col("_seg") == seg)
    n_new, len_new = new_rows.agg(F.count("*"), F.coalesce(F.sum("_doc_len"), F.lit(0))).first()
    signed = gone.select(key, "_mark", F.lit(-1).alias("d")).unionByName(new_rows.select(key, "_mark", F.lit(1).alias("d")))
    _write_digests(index, dg.leaves(signed, _leaf(index, F.col(key)), "_mark", F.col("d")), seg)
    if info["text_col"]:
        came = _write_postings(index, new_rows, seg, n_new)
        went = lexical.frequency_parts(gone, info["text_col"], F.lit(-1))
        _append(index, lexical.summed(came.unionByName(went)), "terms", seg)
    if info["dim"]:
        vectors = written(spark, _vector_rows(index, puts), "vectors")
        _require_vectors(vectors, info["dim"])
        _write_vectors(index, vectors, seg)
    _append(index, touched, "changed", seg)
    if order:
        reached = batch_rows.select(F.col(key).alias("key"), F.lit(stream or "").alias("stream"), F.col("_order").alias("reached"))
        _append(index, reached, "orders", seg)
    info.update(
        segments=info["segments"] + [seg],
        n_docs=info["n_docs"] - n_gone + n_new,
        n_changed=info["n_changed"] + n_changed,
        total_len=info["total_len"] - len_gone + len_new,
    )
    if stream is not None:
        info["streams"][stream] = batch
    _save_info(index)
    return index


def _typed(index: Index, df: DataFrame) -> DataFrame:
    """The synced columns in the types of the index, so that equal values hash alike."""
    kinds = {f.name: f.dataType for f in index.spark.table(index.table("rows")).schema}
    return df.withColumns({c: F.col(c).cast(kinds[c]) for c in index.info["columns"] if df.schema[c].dataType != kinds[c]})


def _tree(index: Index) -> dg.Tree:
    return dg.tree(index.committed("digests"))


def changes_since(index: Index, source: DataFrame | Index) -> DataFrame | None:
    """`op` and the synced columns: what turns the index into `source`; None if nothing does.

    A table is read once for its tree, and once more where trees differ. Another index (a replica's
    original, with the same columns and number of leaves) has its tree already: of both sides only
    the differing shards are read.
    """
    info, spark = index.info, index.spark
    key = info["primary_key"]
    told = isinstance(source, Index) and all(source.info[k] == info[k] for k in ("n_leaves", "columns", "primary_key"))
    rows = source.live("rows") if isinstance(source, Index) else source
    new = _typed(index, rows.select(*info["columns"], *(["_mark", "_shard"] if told else [])))
    if told:
        leaves = dg.differing(_tree(index), _tree(source))
    else:
        new = new.withColumn("_mark", dg.mark_of(new, key, info["columns"]))
        own = written(spark, dg.levels(dg.leaves(new, _leaf(index, F.col(key)), "_mark")), "digests")
        leaves = dg.differing(_tree(index), dg.tree(own))
    if leaves is None:
        return None
    leaves, n = counted(spark, leaves, "differing")
    side = small_side(leaves, n)

    def within(df: DataFrame) -> DataFrame:
        placed = df.withColumn("node", _leaf(index, F.col(key)))
        return placed.join(side, "node", "left_semi").drop("node") if n < info["n_leaves"] else placed.drop("node")

    before = within(_in_shards(index, index.live("rows"), leaves).select(key, F.col("_mark").alias("_old")))
    after = within(_in_shards(source, new, leaves) if told else new).drop("_shard").withColumn("_has", F.lit(True))
    op = (
        F.when(F.col("_has").isNull(), "delete")
        .when(F.col("_old").isNull(), "insert")
        .when(F.col("_old") != F.col("_mark"), "update")
    )
    both = before.join(after, key, "full_outer").withColumn("op", op)
    return both.filter(F.col("op").isNotNull()).select("op", *info["columns"])


def sync(index: Index, source: DataFrame | Index) -> Index:
    """Bring the index to the state of `source` (triggered sync), a table or another index."""
    changes = changes_since(index, source)
    return index if changes is None else apply_changes(index, changes)


def compact(index: Index, name: str) -> Index:
    """A fresh index `name` over the live rows, in one segment. Source table and stream
    positions go with it, so a batch that is replayed is still passed over."""
    info = index.info
    fresh = create_index(
        index.live("rows").select(*info["columns"]),
        name,
        info["primary_key"],
        info["text_col"],
        index.model,
        info["vector_col"],
        info["columns"],
        info["filter_columns"],
        info["n_cells"],
        info["metric"],
        info["pipeline_type"],
        info["source_table"],
        info["positions"],
    )
    fresh.info["streams"] = dict(info["streams"])
    if index.spark.catalog.tableExists(index.table("orders")):
        _append(fresh, index.committed("orders").drop("_seg"), "orders", 0)
    _save_info(fresh)
    return fresh


def save_vectors(index: Index, table: str, save: bool = False) -> bool:
    """Copy the computed vectors to a table of their own; off unless asked for."""
    if save:
        tables.overwrite(index.live("vectors").select("key", "vector"), table)
    return save
