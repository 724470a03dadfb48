"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to lower-case words joined by single spaces; the windows of all
items (thirteen consecutive words, or the whole of a shorter item) go into one automaton,
and each document is scanned once. The end of an occurrence gives its words, and the
words their places in the original text.

Spark cuts the items into windows, and writes them to the shared folder in groups of about `AUTOMATON_CHARS`; a
task builds the automaton of a group from its files. With more than one group, a task holds a block of
`BLOCK_CHARS` of its documents, and takes it through the automata one after the other, so
that the benchmark may be of any size, and documents are read once. A document longer than a block is
one by itself. Null or wordless texts have no words; items without words and
items without id are never found; items that share an id count once; rows of documents are
kept as they are, repeated or null ids included. Other columns, whatever their names, pass
through; empty tables give empty results, or documents without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsift.llm import store

WINDOW = 13
AUTOMATON_CHARS = 1 << 22  # of the windows in one automaton, about
BLOCK_CHARS = 1 << 25  # of the documents that a task takes through several automata
#: A-Z to a-z; other ASCII characters that are neither letters nor digits to a blank.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
ADDED = ["__n_words", "__n_hit", "__items", "__spans"]
FOUND = (
    "__n_words long, __n_hit long, __items array<string>, "
    "__spans array<struct<first:int,last:int,start:int,end:int>>"
)
_SPAN = pa.struct([(name, pa.int32()) for name in ("first", "last", "start", "end")])
_machines: dict[tuple, object] = {}  # the last one used


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def windows_of(text: str | None, size: int = WINDOW) -> list[str]:
    """Windows of an item, delimited by blanks; one character stands for one byte."""
    words = words_of(text)
    runs = [words] if 0 < len(words) < size else [words[i : i + size] for i in range(len(words) - size + 1)]
    return [f" {b' '.join(r).decode('latin-1')} " for r in runs]


def automaton(pairs):
    """An automaton of pairs (window, item), whose values are the length in words of a window and its
    items; None without windows."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for window, item in pairs:
        known = machine.get(window, None)
        if known is None:
            machine.add_word(window, (window.count(" ") - 1, [item]))
        else:
            known[1].append(item)
    if not len(machine):
        return None
    machine.make_automaton()
    return machine


def occurrences(machine, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, the hit runs (first word and the one after the last), and the items found."""
    words = words_of(text)
    if machine is None or not words:
        return len(words), [], set()
    clean = f" {b' '.join(words).decode('latin-1')} "
    found = [(end, *value) for end, value in machine.iter(clean)]
    if not found:
        return len(words), [], set()
    blanks = np.flatnonzero(np.frombuffer(clean.encode("latin-1"), np.uint8) == 32)
    after = np.searchsorted(blanks, [end for end, *_ in found])
    begin = after - np.array([n for _, n, _ in found])
    return len(words), _runs(len(words), zip(begin.tolist(), after.tolist(), strict=True)), {i for *_, of in found for i in of}


def _runs(n_words: int, parts) -> list[tuple[int, int]]:
    """The union of runs of words, as runs."""
    steps = np.zeros(n_words + 1, np.int64)
    for a, b in parts:
        steps[a] += 1
        steps[b] -= 1
    edges = np.flatnonzero(np.diff((np.cumsum(steps) > 0).astype(np.int8), prepend=0, append=0)).tolist()
    return list(zip(edges[::2], edges[1::2], strict=True))


def spans_of(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Hit runs with their words and their code points in the original text."""
    if not runs:
        return []
    data = text.encode()
    solid = (np.frombuffer(data.translate(_FOLD), np.uint8) != 32).astype(np.int8)
    edges = np.flatnonzero(np.diff(solid, prepend=0, append=0))
    points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    return [
        {"first": a, "last": b - 1, "start": int(points[edges[2 * a]]), "end": int(points[edges[2 * b - 1]])}
        for a, b in runs
    ]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (window, item) of items, a bounded number at a time."""
    names = ["window", "item"]
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            windows = windows_of(text)
            for i in range(0, len(windows), 8192):
                part = windows[i : i + 8192]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([item] * len(part))], names=names)


def window_groups(spark: SparkSession, items: DataFrame) -> list[list[str]]:
    """The files of each group of distinct pairs (window, item). Pairs are dealt by a hash of both, so that
    neither a long item nor a window of many items makes a group larger than the others."""
    texts = store.text_of(items, "item_id", "text", "string").where("doc_id IS NOT NULL AND text IS NOT NULL")
    pairs = texts.mapInArrow(_cut, "window string, item string").distinct()
    pairs = store.keep(spark, pairs, "windows")
    size = pairs.agg(F.sum(F.length("window") + F.length("item")).alias("n")).first()["n"] or 0
    n = -(-size // AUTOMATON_CHARS)
    if n <= 1:
        return [sorted(pairs.inputFiles())]
    group = F.pmod(F.xxhash64("window", "item"), F.lit(n))
    path = store.folder(spark, "window-groups") + "/rows"
    pairs.withColumn("group", group).repartition("group").write.partitionBy("group").parquet(path)
    groups: dict[str, list[str]] = {}
    for name in sorted(spark.read.parquet(path).inputFiles()):
        groups.setdefault(name.rsplit("/", 2)[1], []).append(name)
    return list(groups.values())


def _pairs_of(files: list[str]) -> Iterator[tuple[str, str]]:
    for name in files:
        fs, at = store.opened(name)
        with fs.open_input_file(at) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=8192, columns=["window", "item"], use_threads=False):
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def _machine(files: list[str]):
    key = tuple(files)
    if key not in _machines:
        _machines.clear()
        _machines[key] = automaton(_pairs_of(files))
    return _machines[key]


def _blocks(batches: Iterator[pa.RecordBatch], at: int, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches that hold about `limit` bytes of texts together; a batch of more is cut."""
    held, size = [], 0
    for batch in batches:
        begin = 0
        for i, n in enumerate(pc.binary_length(batch.column(at)).to_pylist()):
            size += n or 0
            if size > limit:
                yield [*held, batch.slice(begin, i + 1 - begin)]
                held, size, begin = [], 0, i + 1
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield held


def _scanner(groups: list[list[str]], at: int):
    def added(texts: list[str | None], order: list[list[str]]) -> list[pa.Array]:
        counts = [0] * len(texts)
        runs: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for files in order:
            machine = _machine(files)
            for i, text in enumerate(texts):
                counts[i], hit, of = occurrences(machine, text)
                if hit:
                    runs[i] = _runs(counts[i], runs[i] + hit) if i in runs else hit
                    items.setdefault(i, set()).update(of)
        hits = [sum(b - a for a, b in runs.get(i, ())) for i in range(len(texts))]
        return [
            pa.array(counts, pa.int64()),
            pa.array(hits, pa.int64()),
            pa.array([sorted(items.get(i, ())) for i in range(len(texts))], pa.list_(pa.string())),
            pa.array([spans_of(t or "", runs.get(i, [])) for i, t in enumerate(texts)], pa.list_(_SPAN)),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several = len(groups) > 1
        order = groups
        for block in _blocks(batches, at, BLOCK_CHARS) if several else ([b] for b in batches):
            texts = [b.column(at).to_pylist() for b in block]
            new = added([t for part in texts for t in part], order)
            order = order[::-1]  # the next block begins with the automaton that is there
            begin = 0
            for batch in block:
                more = [c.slice(begin, batch.num_rows) for c in new]
                begin += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *ADDED])

    return run


def annotate(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs`, all columns as `c0, c1, ...`, with those of `ADDED`: number of words, of hit words, the ids of the
    items found (as strings, in order), and the hit runs as spans of the original text."""
    rows, at = store.numbered(docs), store.place(docs, text_col)
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(FOUND).fields])
    return rows.mapInArrow(_scanner(window_groups(spark, items), at), schema)


def find(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of `docs(doc_id, text)` what `annotate` adds, without the text."""
    found = annotate(spark, docs.select("doc_id", "text"), items)
    return found.select(F.col("c0").alias("doc_id"), *(F.col(n).alias(n.strip("_")) for n in ADDED))


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """The rule: at least a twentieth of the words are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of `docs`, all columns, that the rule leaves clean; null texts are clean."""
    clean = annotate(spark, docs, items).where(~is_contaminated("__n_hit", "__n_words"))
    return clean.drop(*ADDED).toDF(*docs.columns)
