"""Mixing sources to target weights.

The words of each source are summed, the target of a source is its weighted share of the wanted total, and a source
repeats its documents at the rate target / size: each document `floor(rate)` times, and once more if a hash of
its id and text, as a number between 0 and 1, is below the fraction. So every document is drawn by itself, a
rerun draws the same, and nothing is sorted, windowed or gathered by source.

A target stops at `most` times the size of its source. What is above it is shared again among the others by their
weights, until none is above. Sources are one row each and stay in Spark; a round of sharing sends two sums to the driver.

A null text has 0 words, and so have empty and blank ones; very long texts are counted whole. Null is a source of its own, the last. A source
without words has target 0 and gives no copies. Documents with null id take part and are drawn by their text;
rows that share id and text are drawn alike, each counts. An empty table gives an empty mix. If all targets stop, the mix
is smaller than asked. Other columns are carried by `emitted` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm import store
from docsift.session import BROADCAST_ROWS

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2.0, 20
SALTS = 64
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number from 0 to below 1 (of 52 bits) from the id, and the text."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """`doc_id, source, size, u` of every document."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.select("doc_id", "source", n_words(F.col("text")).alias("size"), uniform(F.col("doc_id"), F.col("text"), seed).alias("u"))


def cycled(spark: SparkSession, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """`sizes(source, source_size)` with the weights dealt in turn to the sources, by code point, null last.

    Sources are ranked by range partitions: the number before each partition is added to the
    rank within it, so that no task sees them all.
    """
    dealt = sizes.withColumn("last", F.col("source").isNull())
    dealt = dealt.repartitionByRange(store.parts_of(spark), "last", "source").withColumn("part", F.spark_partition_id())
    dealt = store.keep(spark, dealt, "sources")
    counts = sorted((r["part"], r["n"]) for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect())
    offsets, before = [], 0
    for part, n in counts:  # one row a partition
        offsets.append((part, before))
        before += n
    ranked = dealt.join(F.broadcast(spark.createDataFrame(offsets, "part int, before long")), "part")
    within = F.row_number().over(Window.partitionBy("part").orderBy("last", "source"))
    turn = F.pmod(F.col("before") + within - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    return ranked.select("source", "source_size", weight.alias("weight"))


def targets(spark: SparkSession, weighted: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`weighted(source, source_size, weight)` with `target`."""
    weighted = store.keep(spark, weighted, "weights")
    cap = F.col("source_size") * F.lit(float(most))
    whole = weighted.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    rest, among = whole * float(share), None
    while True:
        # A source is full if its share of what the sources that are not full have left passes its cap.
        full = F.lit(False) if among is None else F.col("weight") * F.lit(rest) / F.lit(among) > cap
        sums = weighted.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("among"),
        ).first()
        left = whole * float(share) - sums["full"]
        if (left, sums["among"]) == (rest, among) or not sums["among"]:
            break
        rest, among = left, sums["among"]
    if not sums["among"]:
        return weighted.withColumn("target", F.when(F.col("weight") > 0, cap).otherwise(0.0))
    return weighted.withColumn("target", F.when(full, cap).otherwise(F.col("weight") * F.lit(rest) / F.lit(among)))


def joined(rows: DataFrame, sources: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`rows(source, u, ...)` with the columns of `sources(source, ...)`: broadcast if these are few, else dealt by
    source and salt, so that a source with a third of the rows is spread."""
    sources = sources.withColumnRenamed("source", "of")
    if sources.count() <= limit:
        return rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    salted = rows.withColumn("salt", F.floor(F.col("u") * SALTS))
    spread = sources.withColumn("its", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    on = F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("its"))
    return salted.join(spread, on, "left").drop("of", "its", "salt")


def source_targets(
    spark: SparkSession, rows: DataFrame, weights: DataFrame | tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """`source, source_size, target` of the sources of `rows(source, size, ...)`.

    `weights` are dealt to the sources in turn, or come as a table `source, weight` with one row a source; a source that it does
    not name has weight 0.
    """
    sizes = store.keep(spark, rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    if isinstance(weights, DataFrame):
        named = weights.select(F.col("source").cast("string").alias("of"), F.col("weight").cast("double"))
        weighted = sizes.join(named, F.col("source").eqNullSafe(F.col("of")), "left").drop("of").na.fill({"weight": 0.0})
    else:
        weighted = cycled(spark, sizes, weights)
    return store.keep(spark, targets(spark, weighted, share, most).select("source", "source_size", "target"), "targets")


def copies() -> Column:
    """How often a document is taken, from `target, source_size, u`."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return F.floor(rate) + (F.col("u") < rate - F.floor(rate)).cast("long")


def planned(
    spark: SparkSession, rows: DataFrame, weights: DataFrame | tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """`rows(doc_id, source, size, u)` with `source_size, target, copies`."""
    rows = store.keep(spark, rows, "sizes")
    return joined(rows, source_targets(spark, rows, weights, share, most)).withColumn("copies", copies())


def emitted(
    spark: SparkSession, docs: DataFrame, weights: DataFrame | tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED,
) -> DataFrame:
    """The mix: rows of `docs`, all columns, as often as it takes them.

    The targets come to the documents, which draw by the same hash; texts move only if the sources are too many to be sent to all.
    """
    told = source_targets(spark, measured(docs, id_col, text_col, source_col, seed), weights, share, most)
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    u = uniform(F.col(f"row.`{id_col}`").cast("long"), F.col(f"row.`{text_col}`").cast("string"), seed)
    both = joined(row.withColumns({"source": F.col(f"row.`{source_col}`").cast("string"), "u": u}), told)
    taken = both.withColumn("n", copies().cast("int")).where("n > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
