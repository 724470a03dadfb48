"""Name a computed value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    A column referred to inside a lambda is otherwise inlined by the optimizer
    and computed again for every array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def pieces(items: Column, size: int = 256) -> Column:
    """The array cut into arrays of `size` elements at most, one (empty) at least.

    A fold that appends to its state copies all it has at every step. Folding piece
    by piece, and over the pieces, keeps what is copied short.
    """

    def cut(whole: Column) -> Column:
        last = F.floor(F.greatest(F.size(whole) - 1, F.lit(0)) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(whole, i * size + 1, size))

    return let(items, cut)
