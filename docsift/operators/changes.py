"""Keys, snapshot differences and change application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.session import counted, small_side


def key_faults(df: DataFrame, key: str) -> DataFrame:
    """`key, n`: keys that are null or held by more than one row; empty is good."""
    counted = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    return counted.filter(F.col("key").isNull() | (F.col("n") > 1))


def require_key(df: DataFrame, key: str) -> int:
    """Fail unless every row has a key of its own; return the number of rows."""
    sizes = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    bad = F.col("key").isNull() | (F.col("n") > 1)
    n, faults = sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(bad.cast("int")), F.lit(0))
    ).first()
    if faults:
        worst = key_faults(df, key).limit(3).collect()
        raise ValueError(f"{key} is not a primary key: {[(r['key'], r['n']) for r in worst]}")
    return n


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """Hash over the columns in name order; a null differs from every value."""
    parts = []
    for name in sorted(columns):
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`key, op` plus the new column values: what turns `old` into `new`.

    Only key and a 64-bit row hash of each side meet in the full outer join. The
    changed keys are written and counted, so that the wide columns can be fetched
    without moving `new` when the changes are few.
    """
    before = old.select(F.col(key), row_hash(old, columns).alias("_old"), F.lit(True).alias("_had"))
    after = new.select(F.col(key), row_hash(new, columns).alias("_new"), F.lit(True).alias("_has"))
    op = (
        F.when(F.col("_had").isNull(), "insert")
        .when(F.col("_has").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    differing = before.join(after, key, "full_outer").select(key, op.alias("op")).filter(F.col("op").isNotNull())
    changed, n = counted(old.sparkSession, differing, "changed-keys")
    puts = changed.filter(F.col("op") != "delete")
    put_rows = new.select(key, *columns).join(small_side(puts, n), key).select(key, "op", *columns)
    gone = changed.filter(F.col("op") == "delete")
    return put_rows.unionByName(gone, allowMissingColumns=True)


def latest_per_key(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest change of each key.

    An aggregate, not a window: each task reduces a key to one row before the
    shuffle, so a key with most of the rows costs no more than any other.
    """
    rest = [c for c in changes.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return changes.groupBy(key).agg(newest).select(key, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*changes.columns)


def apply_changes(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """`rows` after the changes (`key, op, columns`), one change per key."""
    stored, n = counted(rows.sparkSession, changes, "changes")
    kept = rows.join(small_side(stored.select(key), n), key, "left_anti")
    added = stored.filter(F.col("op") != "delete").select(*rows.columns)
    return kept.unionByName(added)
