"""Digest trees: sums over ranges of hashed keys that tell where two tables differ.

A row's mark is a 64-bit hash of its key and columns. A leaf of the tree takes the rows whose hashed
key falls into it, and holds how many they are and the xor of their marks; a node of the
level above does so for `FAN` leaves, and the root for all. Counts add and marks cancel,
so a tree follows changes by what they take away and put in, without reading the rest.

Two trees are compared from the root: equal roots end it, and a lower level is looked at
only below nodes that differ. Two leaves that differ pass for equal with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.operators.changes import row_hash

FAN = 1024
ROWS_PER_LEAF = 256
LEVELS = (0, 1, 2)  # root, middle, leaves
FEW_NODES = 2000

#: Nodes `level, node, n, mark` of some levels, those below the given nodes of the level above (all, if None).
Tree = Callable[[list[int], list[int] | None], DataFrame]


def leaf_count(n: int) -> int:
    return max(64, -(-n // ROWS_PER_LEAF))


def leaf_of(key: Column, n_leaves: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(n_leaves))


def mark_of(df: DataFrame, key: str, columns: list[str]) -> Column:
    return row_hash(df, [key, *(c for c in columns if c != key)])


def leaves(rows: DataFrame, leaf: Column, mark: str = "mark", sign: Column | None = None) -> DataFrame:
    """`node, n, mark` per leaf; `sign` is 1 for rows put in, -1 for rows taken away."""
    one = F.lit(1) if sign is None else sign
    return rows.groupBy(leaf.alias("node")).agg(
        F.sum(one.cast("bigint")).alias("n"), F.bit_xor(mark).alias("mark")
    )


def merged(nodes: DataFrame) -> DataFrame:
    """Signed parts of nodes summed up; a node without rows is none."""
    whole = nodes.groupBy("level", "node").agg(F.sum("n").alias("n"), F.bit_xor("mark").alias("mark"))
    return whole.filter((F.col("n") != 0) | (F.col("mark") != 0))


def levels(leaf_rows: DataFrame) -> DataFrame:
    """`level, node, n, mark` of all levels over `leaf_rows(node, n, mark)`."""
    above = F.array(
        F.struct(F.lit(0).alias("level"), F.lit(0).cast("bigint").alias("node")),
        F.struct(F.lit(1).alias("level"), F.floor(F.col("node") / FAN).cast("bigint").alias("node")),
        F.struct(F.lit(2).alias("level"), F.col("node").cast("bigint").alias("node")),
    )
    each = leaf_rows.select(F.explode(above).alias("at"), "n", "mark")
    return each.groupBy("at.level", "at.node").agg(F.sum("n").alias("n"), F.bit_xor("mark").alias("mark"))


def tree(stored: DataFrame) -> Tree:
    """The tree over rows `level, node, n, mark`, which may come in signed parts."""

    def nodes(levels: list[int], below: list[int] | None) -> DataFrame:
        rows = stored.filter(F.col("level").isin(levels))
        if below is not None:
            rows = rows.filter(F.floor(F.col("node") / FAN).isin(below))
        return merged(rows.select("level", "node", "n", "mark"))

    return nodes


def differing(old: Tree, new: Tree) -> DataFrame | None:
    """`node` of the leaves that differ; None if the trees are equal."""

    def unequal(levels: list[int], below: list[int] | None = None) -> DataFrame:
        a = old(levels, below)
        b = new(levels, below).select("level", "node", F.col("n").alias("_n"), F.col("mark").alias("_mark"))
        same = F.col("n").eqNullSafe(F.col("_n")) & F.col("mark").eqNullSafe(F.col("_mark"))
        return a.join(b, ["level", "node"], "full_outer").filter(~same).select("level", "node")

    # The root, and one node a FAN leaves; where very many of these differ, all leaves are compared.
    above = unequal([0, 1]).limit(FEW_NODES + 1).collect()
    if not above:
        return None
    below = [r["node"] for r in above if r["level"] == 1] if len(above) <= FEW_NODES else None
    return unequal([2], below).select("node")
