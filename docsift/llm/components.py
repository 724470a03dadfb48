"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select(F.explode(F.array(F.struct("a", "b"), back)).alias("e")).select("e.a", "e.b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """How many edges there are, and a sum that changes with them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """`node, component` of every node of `edges(a, b)`; a component is named by its
    smallest node. Stars shrink towards it until nothing moves: a number of rounds
    logarithmic in the nodes. No neighbourhood is gathered; null ends and loops are ignored. A round over
    few edges takes no shuffle."""
    now = store.keep(spark, edges.where("a <> b").select("a", "b"), "edges")
    mark, last = _mark(now), None
    while mark != last:
        after = store.keep(spark, _small_star(_large_star(store.packed(now, mark[0]))), "edges")
        store.drop(spark, now)
        now, last, mark = after, mark, _mark(after)
    now = store.packed(now, mark[0])
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
