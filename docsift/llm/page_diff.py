"""Main text of web pages: structure first, then differences between neighbouring pages.

A page is a sequence of lines, the text of its blocks. Pages of a host are ordered by path, each is paired
with the neighbour that shares more of its path, and their lines are aligned by longest common subsequence: lines that
both have are template, the others are the page's own. A neighbour with the same lines throughout is a
copy, which tells nothing: the other neighbour is taken, or none. Every page goes through this.

Markup then tells what own lines can be: what lies in scripts, menus, page headers and footers, asides, forms, adverts,
notices and comments is no main text. A declared article, or else a main part, settles the page if it holds at least
a third of the text that is its own or the page's own elsewhere, and is then taken whole, as copies of a page share their
articles. A smaller one is a teaser, which settles nothing: the main text is all own lines, wherever they lie.

Character references are decoded, white space in a line becomes one blank, and lines are
joined by one blank; nothing else is dropped. Null html is empty; pages without host are not
paired; repeated rows are copies of one another; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import store
from docsift.llm.html_lines import ARTICLE, BESIDE, MAIN, lines


#: A declared part settles a page if so many times its text is no less than the text in question.
SHARE = 3


def settled(page: list[tuple[str, str]], template: Collection[int] = ()) -> list[bool]:
    """Whether each line is main text, given the positions of the lines that the nearest page has too."""
    shared = set(template)
    own = [place != BESIDE and i not in shared for i, (_, place) in enumerate(page)]
    for declared in (ARTICLE, MAIN):
        inside = sum(len(text) for text, place in page if place == declared)
        beyond = sum(len(text) for (text, place), o in zip(page, own, strict=True) if o and place != declared)
        if inside and SHARE * inside >= inside + beyond:
            return [place == declared for _, place in page]
    return own


def _last_row(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of `a` and each beginning of `b`."""
    masks: dict = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        match = row & masks.get(x, 0)
        row = ((row + match) | (row - match)) & full
    size = (len(b) + 7) // 8
    bits = np.unpackbits(np.frombuffer(row.to_bytes(size, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list, b: list) -> list[int]:
    """Positions in `a` of a longest common subsequence of `a` and `b`, in memory linear in
    their lengths: equal ends are set aside, and long rests are halved."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[len(a) - 1 - high] == b[len(b) - 1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    if not x or not y or not set(x) & set(y):
        middle = []
    elif len(x) == 1:
        middle = [0] if x[0] in y else []
    else:
        half = len(x) // 2
        total = _last_row(x[:half], y) + _last_row(x[half:][::-1], y[::-1])[::-1]
        cut = int(total.argmax())
        middle = common(x[:half], y[:cut]) + [half + i for i in common(x[half:], y[cut:])]
    return [*range(low), *(low + i for i in middle), *range(len(a) - high, len(a))]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the lines."""
    for batch in batches:
        hashes = [[_hash(text) for text, _ in lines(page)] for page in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in (0, 1, 2, 4)] + [pa.array(hashes, pa.list_(pa.int64()))],
            names=["page_id", "host", "path", "mark", "hashes"],
        )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        pos = pa.array(np.arange(n, n + batch.num_rows))
        n += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(batch.num_rows, part)), pos], names=[*batch.schema.names, "part", "pos"]
        )


def _shared_length(one: str, two: str) -> tuple[int, int]:
    """Path segments, and characters, that two paths begin with in common."""
    a, b = one.split("/"), two.split("/")
    segments = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    chars = next((i for i, (x, y) in enumerate(zip(one, two, strict=False)) if x != y), min(len(one), len(two)))
    return segments, chars


def template_lines(own: dict, neighbours: list[dict]) -> list[int]:
    """Positions of the lines that the nearest neighbour has too."""
    usable = [x for x in neighbours if x["hashes"] and x["hashes"] != own["hashes"]]
    if not usable:
        return []
    nearest = max(usable, key=lambda x: _shared_length(own["path"], x["path"]))
    return common(own["hashes"], nearest["hashes"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        found = []
        for row in rows:
            beside = [
                {"hashes": row[f"hashes_{w}"], "path": row[f"path_{w}"]}
                for w in ("before", "after")
                if row[f"host_{w}"] == row["host"]
            ]
            found.append(template_lines(row, beside))
        some = [i for i, f in enumerate(found) if f]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i]["page_id"] for i in some], pa.int64()),
                pa.array([rows[i]["mark"] for i in some], pa.int64()),
                pa.array([found[i] for i in some], pa.list_(pa.int32())),
            ],
            names=["page_id", "mark", "drop"],
        )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, drop in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            found = lines(page)
            main = settled(found, drop or ())
            texts.append(" ".join(t for (t, _), m in zip(found, main, strict=True) if m))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def _mark():
    return F.xxhash64("url", "html")


def templates(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """`page_id, mark, drop`: for pages with template lines, which (`pages(page_id, url, html)`)."""
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"[?#].*$", ""), r"^//", "")
    host = F.lower(F.substring_index(bare, "/", 1))
    path = F.expr("substring(bare, length(host) + 1)")
    keyed = pages.withColumns({"bare": bare, "mark": _mark()}).withColumn("host", F.lower(F.substring_index("bare", "/", 1)))
    keyed = keyed.withColumn("path", path).select("page_id", "host", "path", "html", "mark")
    schema = "page_id long, host string, path string, mark long, hashes array<long>"
    outlines = store.keep(spark, keyed.where("host <> ''").mapInArrow(_outlined, schema), "page-lines")

    order = ["host", "path", "page_id", "mark"]
    ordered = outlines.repartitionByRange(store.parts_of(spark), *order).sortWithinPartitions(*order)
    placed = store.keep(spark, ordered.mapInArrow(_numbered, f"{schema}, part long, pos long"), "page-order")
    # One row a partition: where it begins in the order of all pages.
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    begin, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, begin))
        begin += n
    offsets = spark.createDataFrame(offsets, "part long, begin long")
    placed = placed.join(F.broadcast(offsets), "part").withColumn("at", F.col("begin") + F.col("pos"))

    def moved(by: int, name: str) -> DataFrame:
        columns = [F.col(c).alias(f"{c}_{name}") for c in ("host", "path", "hashes")]
        return placed.select((F.col("at") + by).alias("at"), *columns)

    rows = placed.join(moved(1, "before"), "at", "left").join(moved(-1, "after"), "at", "left")
    rows = rows.select(
        "page_id", "mark", "host", "path", "hashes",
        *(f"{c}_{w}" for w in ("before", "after") for c in ("host", "path", "hashes")),
    )
    return rows.mapInArrow(_aligned, "page_id long, mark long, drop array<int>").dropDuplicates(["page_id", "mark"])


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every row of `pages(page_id, url, html)`."""
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    drop = store.keep(spark, templates(spark, pages), "page-templates")
    drop = drop.select(F.col("page_id").alias("of"), F.col("mark").alias("its"), "drop")
    both = pages.withColumn("mark", _mark())
    both = both.join(drop, (F.col("mark") == F.col("its")) & F.col("page_id").eqNullSafe(F.col("of")), "left")
    return both.select("page_id", "url", "html", "drop").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long"
    )
