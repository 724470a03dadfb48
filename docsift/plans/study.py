"""What a chunk size does to search: counts and hit rate for several sizes in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators import chunk, topk
from docsift.session import counted, small_side


def chunked_at(docs: DataFrame, key: str, text: str, sizes: list[tuple[int, int]]) -> DataFrame:
    """`key, option, pos, chunk`: every text cut at all sizes (`option` is the place in `sizes`), read once."""

    def cut(option: int, size: int, overlap: int):
        windows = chunk.char_windows(F.col(text), size, overlap)
        return F.transform(
            windows, lambda c, i: F.struct(F.lit(option).alias("option"), i.alias("pos"), c.alias("chunk"))
        )

    every = F.concat(*(cut(i, *s) for i, s in enumerate(sizes)))
    rows = docs.filter(F.length(text) > 0).select(key, F.explode(every).alias("c"))
    return rows.select(key, "c.option", "c.pos", "c.chunk")


def size_quality(
    docs: DataFrame, key: str, text: str, queries: DataFrame, relevant: DataFrame, model, sizes: list[tuple[int, int]], k: int = 5
) -> DataFrame:
    """`size, overlap, n_chunks, mean_chars, n_queries, hit_rate, precision` per option of `sizes`.

    Each of `queries(query_id, query_text)` with a document in `relevant(query_id, key)` is searched among the chunks of
    each size. A hit is a query with a chunk of such a document among its first `k`; precision is the share of those chunks
    that are of such a document. Queries number below 2^63 / number of sizes.
    """
    spark, n = docs.sparkSession, len(sizes)
    pieces = chunked_at(docs, key, text, sizes)
    vectors = pieces.select(
        F.concat_ws("#", "option", key, "pos").alias("key"), model.column(F.col("chunk")).alias("vector"), F.col("option").alias("cell")
    )
    judged = relevant.select("query_id", F.col("key").alias("_doc")).distinct()
    judged, n_judged = counted(spark, judged, "relevant")
    asked = queries.join(judged.select("query_id").distinct(), "query_id", "left_semi")
    asked, n_queries = counted(spark, asked.select("query_id", model.column(F.col("query_text")).alias("vector")), "asked")
    option = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    each = asked.withColumn("option", option).select(
        (F.col("query_id") * n + F.col("option")).alias("query_id"), "vector", F.array("option").alias("probes")
    )
    # An option is a cell: its chunks are scored by one matrix product with the queries, not query by query.
    hits = topk.nearest(vectors, each, k, within="cells")
    parts = F.split("key", "#")
    hits = hits.select(
        F.floor(F.col("query_id") / n).cast("long").alias("query_id"), parts[0].cast("int").alias("option"), parts[1].cast(docs.schema[key].dataType).alias("_doc")
    )
    good = judged.withColumn("good", F.lit(1))
    seen = hits.join(small_side(good, n_judged), ["query_id", "_doc"], "left")
    of_query = seen.groupBy("option", "query_id").agg(F.max(F.coalesce("good", F.lit(0))).alias("hit"), F.avg(F.coalesce("good", F.lit(0))).alias("share"))
    found = of_query.groupBy("option").agg(F.sum("hit").alias("hits"), F.sum("share").alias("shares"))
    counts = chunk.size_study(docs, text, sizes).select("size", "overlap", "n_chunks", "mean_chars")
    options = spark.createDataFrame([(i, *s) for i, s in enumerate(sizes)], "option int, size int, overlap int")
    rate = lambda c: F.round(F.coalesce(F.col(c), F.lit(0)) / n_queries, 6) if n_queries else F.lit(None).cast("double")
    rows = counts.join(F.broadcast(options), ["size", "overlap"]).join(found, "option", "left")
    return rows.select(
        "size", "overlap", "n_chunks", "mean_chars", F.lit(n_queries).cast("long").alias("n_queries"), rate("hits").alias("hit_rate"), rate("shares").alias("precision")
    )
