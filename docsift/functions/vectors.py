"""Vector arithmetic on array columns, in doubles and in array order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions.let import let


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, higher is better; null when either norm is zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def l2(a: Column, b: Column) -> Column:
    """Euclidean distance, lower is better."""
    gap = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(_sum(F.transform(gap, lambda d: d * d)))


def l1(a: Column, b: Column) -> Column:
    """Manhattan distance, lower is better."""
    gap = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    return _sum(gap)


def normalise(a: Column) -> Column:
    """Unit-length copy; null for a zero vector."""
    length = F.nullif(norm(a), F.lit(0.0))
    return let(length, lambda n: F.when(n.isNotNull(), F.transform(a, lambda x: x.cast("double") / n)))


def shorten(a: Column, dim: int) -> Column:
    """First `dim` components, brought back to unit length."""
    return normalise(F.slice(a, 1, dim))


def is_valid(a: Column, dim: int) -> Column:
    """True for a vector of `dim` finite, non-null components."""
    bad = F.exists(
        a,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return F.coalesce((F.size(a) == dim) & ~bad, F.lit(False))


def micro(a: Column) -> Column:
    """Components in millionths, joined by blanks: one exact, printable form."""
    return F.array_join(F.transform(a, lambda x: F.round(x.cast("double") * 1e6).cast("bigint")), " ")
