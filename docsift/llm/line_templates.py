"""Line deduplication by a fixed-depth tree of line templates.

A line is its words (between white space, A-Z as a-z); a word with a digit is a variable
field. The tree has the number of words at its first level and the leading `LEAD`
words below; its leaves hold templates: the line itself, and, for lines of `GENERAL` words or more, the
line with one fifth of the words after the leading ones left open. Two lines share a template if they
have the same path and differ in variable fields or within one open fifth only. A template
recurs if it occurs in `min_docs` documents or more. A recurring line stays in the
document with the smallest id that holds its template, and is dropped from all others; a line of fewer
than `short` words stays (`SHORT` unless the caller says otherwise; 1 exempts no line).

Templates are compared as 64-bit hashes, so a frequent line is one key whose rows are
counted before they move. Blank lines stay and do not count. A text that loses nothing is
returned unchanged; null text stays null; rows without id lose nothing; rows that share an id are one
document. An empty table gives an empty result. Other columns, whatever their names, are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsift.llm import store
from docsift.llm.pretoken import Hasher, chunked, mix

LEAD, FIELDS, GENERAL, SHORT = 3, 5, 10, 5
ADDED = ["__n_lines", "__n_dropped", "__blank"]
_MASK = (1 << 64) - 1
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_hasher = Hasher(256, seed=5)
_FIELD = np.uint64(0xA0761D6478BD642F)  # stands for any word with a digit
_P = 0xD1342543DE82EF95
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
                steps = np.full(max(n, 1 << 16), base, np.uint64)
                steps[0] = 1
                _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and line number of every word."""
    out: list[list[np.ndarray]] = [[], [], []]
    lines = np.zeros(len(texts) + 1, np.int64)
    for numbers, group in chunked(texts):
        parts = [t.encode() for t in group]
        data = np.frombuffer((b" ".join(parts) + b" ").translate(_LOWER), np.uint8)
        edges = np.flatnonzero(np.diff((~_BLANK[data]).astype(np.int8), prepend=0))
        starts, ends = edges[::2], edges[1::2]
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        upto = np.cumsum([len(p) + 1 for p in parts])
        begin = upto - [len(p) + 1 for p in parts]
        part = np.searchsorted(upto, starts, side="right")
        hashes = _hasher(data, starts, ends)
        hashes[digits[ends] > digits[starts]] = _FIELD
        # Segments of one text follow one another, so its line count carries on.
        carried = np.empty(len(parts), np.int64)
        for i, number in enumerate(numbers.tolist()):
            carried[i] = lines[number]
            lines[number] += breaks[upto[i]] - breaks[begin[i]]
        out[0].append(hashes)
        out[1].append(numbers[part])
        out[2].append(carried[part] + breaks[starts] - breaks[begin[part]])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def line_keys(texts: list[str], short: int = SHORT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every line with words: its text, its number, its words, and its template hashes
    (columns: the line itself, then with each fifth left open; 0 where there is none)."""
    words, text, line = _words(texts)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 1 + FIELDS), np.int64)
    change = np.flatnonzero((np.diff(text) != 0) | (np.diff(line) != 0)) + 1
    a = np.concatenate([[0], change])
    b = np.concatenate([change, [n]])
    size = b - a
    up, down = _power(n + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.astype(np.uint64) * up[:n])])
        whole = (sums[b] - sums[a]) * down[a]
        length = size.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)
        keys = np.zeros((len(a), 1 + FIELDS), np.uint64)
        keys[:, 0] = mix(whole + length)
        rest = size - LEAD
        for i in range(FIELDS):
            c = np.minimum(a + LEAD + rest * i // FIELDS, n)
            d = np.minimum(a + LEAD + rest * (i + 1) // FIELDS, n)
            left_open = (sums[np.maximum(d, c)] - sums[c]) * down[a]
            key = mix(whole - left_open + length + np.uint64((i + 1) * 0x8EBC6AF09C88C6E3 & _MASK))
            keys[:, 1 + i] = np.where((size >= GENERAL) & (d > c), key, 0)
    keys[size < short] = 0
    return text[a], line[a], size, keys.astype(np.int64)


def _emitted(short: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Once a document, each template of it, with the line."""
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            text, _, _, keys = line_keys([t or "" for t in batch.column(1).to_pylist()], short)
            row, column = np.nonzero(keys)
            rows = np.column_stack([text[row], keys[row, column], keys[row, 0]])
            rows = np.unique(rows, axis=0) if len(rows) else rows.reshape(0, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows[:, 0]].astype(np.int64)), pa.array(rows[:, 1]), pa.array(rows[:, 2])],
                names=["doc_id", "template", "line"],
            )

    return run


def line_templates(docs: DataFrame, short: int = SHORT) -> DataFrame:
    """`doc_id, template, line` of `docs(doc_id, text)`, rows without id left out."""
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    return rows.mapInArrow(_emitted(short), "doc_id long, template long, line long")


def dropped_lines(spark: SparkSession, docs: DataFrame, min_docs: int = 2, short: int = SHORT) -> DataFrame:
    """`doc_id, lines`: per document, the hashes of the lines that it loses."""
    rows = line_templates(docs, short)
    recurring = rows.groupBy("template").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    recurring = recurring.where(f"n >= {int(min_docs)}").select("template", "first")
    lost = rows.join(recurring, "template").where("doc_id > first")
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))


def _deduped(
    spark: SparkSession, docs: DataFrame, min_docs: int, id_col: str, text_col: str, short: int
) -> DataFrame:
    """`dedup_lines`, with the columns of `docs` as `c0, c1, ...`."""
    lost = dropped_lines(spark, store.text_of(docs, id_col, text_col), min_docs, short)
    at = store.place(docs, text_col)
    rows = store.numbered(docs)
    rows = rows.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    joined = rows.join(lost, F.col(f"c{store.place(docs, id_col)}") == F.col("doc_id"), "left").drop("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            chosen = [set(x or ()) for x in batch.column(batch.num_columns - 1).to_pylist()]
            text, line, _, keys = line_keys([t or "" for t in texts], short)
            n_lines = np.bincount(text, minlength=len(texts))
            n_dropped = np.zeros(len(texts), np.int64)
            gone: dict[int, set[int]] = {}
            touched = np.array([bool(c) for c in chosen], bool)[text] if len(text) else np.zeros(0, bool)
            for i, j, key in zip(text[touched].tolist(), line[touched].tolist(), keys[touched, 0].tolist(), strict=True):
                if key in chosen[i]:
                    gone.setdefault(i, set()).add(j)
                    n_dropped[i] += 1
            for i, drop in gone.items():
                texts[i] = "\n".join(x for j, x in enumerate(texts[i].split("\n")) if j not in drop)
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(texts, pa.string())
            added = [pa.array(n_lines), pa.array(n_dropped), pa.array((n_dropped > 0) & (n_dropped == n_lines))]
            names = [*batch.schema.names[:-1], "__n_lines", "__n_dropped", "__blank"]
            yield pa.RecordBatch.from_arrays(columns + added, names=names)

    added = StructType.fromDDL("__n_lines long, __n_dropped long, __blank boolean")
    return joined.mapInArrow(run, StructType([*rows.schema.fields, *added.fields]))


def dedup_lines(
    spark: SparkSession, docs: DataFrame, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text", short: int = SHORT
) -> DataFrame:
    """`docs`, all columns, with the text that is left, and `__n_lines`, `__n_dropped`, `__blank`:
    lines with words, those dropped, and whether nothing but blanks is left of a text that lost lines."""
    return _deduped(spark, docs, min_docs, id_col, text_col, short).toDF(*docs.columns, *ADDED)


def drop_recurring(
    spark: SparkSession, docs: DataFrame, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text", short: int = 1,
    length_col: str | None = None,
) -> DataFrame:
    """`docs`, the same columns, with the text that is left, without rows that lost all they had; where lines
    went, `length_col` is the new length of the text."""
    left = _deduped(spark, docs, min_docs, id_col, text_col, short).where("NOT __blank")
    if length_col:
        n, text = (F.col(f"c{store.place(docs, c)}") for c in (length_col, text_col))
        left = left.withColumn(f"c{store.place(docs, length_col)}", F.when(F.col("__n_dropped") > 0, F.length(text)).otherwise(n))
    return left.drop(*ADDED).toDF(*docs.columns)
