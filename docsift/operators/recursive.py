"""Recursive character splitting as a table function and as a scalar function.

A text is cut at the first separator of the list that it holds; pieces that
reach `size` are cut again with the later separators, and neighbouring shorter
pieces are packed. Every piece keeps the separator it starts with, so a chunk
is one span of the source, and this module works on spans only.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Separator lists, sizes and overlaps of the two splitters.
PAGE_SEPARATORS = ("\n== page ==\n", "== page ==", "\n\n", "\n", " ", "")
DEFAULT_SEPARATORS = ("\n\n", "\n", " ", "")
PAGE_SIZE, DEFAULT_SIZE, OVERLAP = 2000, 1000, 200

Span = tuple[int, int]


def _pieces(text: str, lo: int, hi: int, separator: str) -> Iterator[Span]:
    start, at = lo, text.find(separator, lo, hi)
    while at >= 0:
        if at > start:
            yield start, at
            start = at
        at = text.find(separator, at + len(separator), hi)
    if start < hi:
        yield start, hi


def _spans(text: str, lo: int, hi: int, separators: Sequence[str], size: int, overlap: int) -> Iterator[Span]:
    index = next((i for i, s in enumerate(separators) if s == "" or text.find(s, lo, hi) >= 0), None)
    if index is None:
        yield lo, hi
        return
    separator, later = separators[index], separators[index + 1 :]
    if separator == "":
        while True:
            end = min(lo + size, hi)
            yield lo, end
            if end == hi:
                return
            lo = end - overlap
    window: deque[Span] = deque()
    for begin, end in _pieces(text, lo, hi, separator):
        if end - begin >= size:
            if window:
                yield window[0][0], window[-1][1]
                window.clear()
            if later:
                yield from _spans(text, begin, end, later, size, overlap)
            else:
                yield begin, end
            continue
        if window and end - window[0][0] > size:
            yield window[0][0], window[-1][1]
            while window and (begin - window[0][0] > overlap or end - window[0][0] > size):
                window.popleft()
        window.append((begin, end))
    if window:
        yield window[0][0], window[-1][1]


def split_text(
    text: str | None, size: int = DEFAULT_SIZE, overlap: int = OVERLAP, separators: Sequence[str] = DEFAULT_SEPARATORS
) -> list[str]:
    """Chunks of one text, stripped, blank ones left out."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    if not text or not text.strip():
        return []
    cut = (text[a:b].strip() for a, b in _spans(text, 0, len(text), separators, size, overlap))
    return [chunk for chunk in cut if chunk]


def split_documents(
    docs: DataFrame,
    key: str,
    text: str,
    size: int = DEFAULT_SIZE,
    overlap: int = OVERLAP,
    separators: Sequence[str] = DEFAULT_SEPARATORS,
) -> DataFrame:
    """`key, pos, chunk` through `mapInPandas`, batch by batch."""
    key_type = docs.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (owner, pos, chunk)
                for owner, body in zip(frame[key].tolist(), frame[text].tolist())
                for pos, chunk in enumerate(split_text(body, size, overlap, separators))
            ]
            yield pd.DataFrame(rows, columns=[key, "pos", "chunk"])

    return docs.select(key, text).mapInPandas(run, f"`{key}` {key_type}, pos int, chunk string")


def split_column(
    docs: DataFrame,
    key: str,
    text: str,
    size: int = DEFAULT_SIZE,
    overlap: int = OVERLAP,
    separators: Sequence[str] = DEFAULT_SEPARATORS,
) -> DataFrame:
    """The same rows through an Arrow-batched scalar function and `posexplode`."""

    @F.udf("array<string>", useArrow=True)
    def cut(body: str) -> list[str]:
        return split_text(body, size, overlap, separators)

    return docs.select(key, F.posexplode_outer(cut(F.col(text))).alias("pos", "chunk")).filter(
        F.col("chunk").isNotNull()
    )


def oversized(chunks: DataFrame, size: int) -> DataFrame:
    """Chunks that no separator in the list could bring under `size`."""
    return chunks.filter(F.length("chunk") > size)
