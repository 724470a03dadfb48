"""Search filters: a map of "column OP" to value, as one predicate."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operator words of a filter key; none means equality.
OPERATORS = ("NOT", "LIKE", "CONTAINS", ">=", "<=", ">", "<")


def parse_key(key: str) -> tuple[str, str]:
    name, _, op = key.strip().partition(" ")
    op = op.strip().upper()
    if op and op not in OPERATORS:
        raise ValueError(f"unknown filter operator {op!r} in {key!r}")
    return name, op


def columns_of(filters: Mapping[str, object] | None) -> list[str]:
    return [parse_key(key)[0] for key in filters or {}]


def _one(name: str, op: str, value) -> Column:
    column = F.col(name)
    many = isinstance(value, (list, tuple, set))
    if op == "":
        return column.isin(list(value)) if many else column == F.lit(value)
    if op == "NOT":
        if many:
            return F.coalesce(~column.isin(list(value)), F.lit(True))
        return ~column.eqNullSafe(F.lit(value))
    if op == "LIKE":
        # Equal to one of the blank-separated tokens of the string.
        return F.array_contains(F.split(column, r"\s+"), F.lit(value))
    if op == "CONTAINS":
        return F.contains(column, F.lit(value))
    return {
        ">": column > F.lit(value),
        ">=": column >= F.lit(value),
        "<": column < F.lit(value),
        "<=": column <= F.lit(value),
    }[op]


def predicate(filters: Mapping[str, object] | None, known: list[str]) -> Column | None:
    """All entries joined by AND; an unknown column or operator is an error."""
    parts = []
    for key, value in (filters or {}).items():
        name, op = parse_key(key)
        if name not in known:
            raise ValueError(f"unknown filter column {name!r}; known: {sorted(known)}")
        parts.append(_one(name, op, value))
    return reduce(lambda a, b: a & b, parts) if parts else None
