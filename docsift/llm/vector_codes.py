"""Product codes of vectors of whole numbers, with nearest entries from memoised grid cells.

A vector is cut into parts (of equal length where the length allows, else by `i * length // parts`), and each part is
coded by the nearest entry of the codebook of its position: squared Euclidean distance, ties to the lower index. The
codebooks start as the parts of the vectors with the smallest ids and are trained by rounds of assignment and
componentwise floor of the mean, over all vectors; an entry that nothing is assigned to stays.

The nearest entry is not sought among all of them. Space is cut into boxes of a coarse grid, a part's box is hashed,
and a task remembers for each box which entries can be nearest to any point in it: those whose smallest distance to
the box is not above the least of the entries' largest distances to it. Only these are evaluated exactly. Boxes whose
hashes collide are told apart by their coordinates, and the table is emptied when it is full, so that neither
changes the result.

A task holds its Arrow batch, the codebooks (parts x entries, whatever the data's size) and the table of boxes. A round
sends sums by part and entry, not vectors. Sums are exact; distances are exact whole numbers, cut to the range of a
long at the end.

Vectors that are null, or hold a null or a non-finite component, are dropped. The length coded is that of the vector
with the smallest id; vectors of another length, which have no parts in these codebooks, keep their row with null
`code` and `error`. Rows with null id are coded but never start a codebook while others can; rows that share an id
are coded each, and start a codebook in the order of their components. Null labels count together. An empty
table gives no rows. Components are cut to the range of a long. Other columns are not read. A table read by
`train` and `coded` is scanned once a round, so it should be stored, not computed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import store
from docsift.session import BROADCAST_ROWS

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BOXES = 4096  # of the grid over the range of a codebook, at most
MEMO = 1 << 13  # boxes that a task remembers for each position
PAIRS = 1 << 20  # part and entry, evaluated at a time
SALTS = 32
_LONG = (1 << 63) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)

Codebooks = list[np.ndarray]


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """`vec_id, label, v`: rows that are not dropped, components as floor(scale * x)."""
    vec = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vec.alias("x"))
    rows = rows.where(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.select("vec_id", "label", F.transform("x", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))


def cuts(length: int, parts: int) -> list[int]:
    return [i * length // parts for i in range(parts + 1)]


def first_vectors(vectors: DataFrame, entries: int) -> list[list[int]]:
    """The vectors that start the codebooks: `entries` at most, all of the length of the first."""
    order = [F.col("vec_id").asc_nulls_last(), "v"]
    lead = vectors.orderBy(*order).limit(1).collect()
    if not lead:
        return []
    same = vectors.where(F.size("v") == len(lead[0]["v"]))
    return [r["v"] for r in same.orderBy(*order).limit(entries).collect()]


def _bits(x: np.ndarray) -> np.ndarray:
    """The low 64 bits of whole numbers."""
    if x.dtype == object:
        return np.array([int(i) & (1 << 64) - 1 for i in x], np.uint64)
    return x.astype(np.uint64)


class Nearest:
    """Nearest entries of one codebook for rows of points."""

    def __init__(self, book: np.ndarray):
        self.book = book  # entries x dimensions, int64 or Python integers
        k, d = book.shape
        self.low = book.min(axis=0) if k else np.zeros(d, book.dtype)
        high = book.max(axis=0) if k else self.low
        # So many cells a dimension that a grid over the codebook has BOXES boxes at most.
        self.cells = max(1, int(round(BOXES ** (1 / d), 9))) if d else 1
        self.step = np.array([(int(h) - int(m)) // self.cells + 1 for m, h in zip(self.low, high, strict=True)], book.dtype)
        self.memo: dict[int, tuple[tuple, np.ndarray]] = {}
        self.evaluated = self.boxes = 0

    def candidates(self, box: np.ndarray) -> np.ndarray:
        """Entries, ascending, that no other entry beats on the whole of each box (rows): padded by -1."""
        begin = self.low + box * self.step
        end = begin + self.step - 1
        least = np.zeros((len(box), len(self.book)), self.book.dtype)
        most = np.zeros_like(least)
        for j in range(self.book.shape[1]):
            below, above = begin[:, j, None] - self.book[:, j], self.book[:, j] - end[:, j, None]
            gap = np.maximum(np.maximum(below, above), 0)
            reach = np.maximum(self.book[:, j] - begin[:, j, None], end[:, j, None] - self.book[:, j])
            least += gap * gap
            most += reach * reach
        return least <= most.min(axis=1, keepdims=True)

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every point."""
        n, d = points.shape
        if not d or not n:
            return np.zeros(n, np.int64), np.zeros(n, self.book.dtype)
        box = (points - self.low) // self.step
        key = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(d):
                key = (key ^ (_bits(box[:, j]) + np.uint64(j))) * _MIX
                key ^= key >> np.uint64(29)
        keys, at, of = np.unique(key, return_index=True, return_inverse=True)
        own = [tuple(b) for b in box[at].tolist()]
        known = [self.memo.get(k) for k in keys.tolist()]
        new = [i for i, entry in enumerate(known) if entry is None or entry[0] != own[i]]
        for a in range(0, len(new), 1024):
            some = new[a : a + 1024]
            open_ = self.candidates(box[at[some]])
            for i, row in zip(some, open_, strict=True):
                known[i] = (own[i], np.flatnonzero(row))
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[int(keys[i])] = known[i]
        self.boxes += len(new)
        found = [k[1] for k in known]
        # A point whose box only shares the hash of the box above is compared with all entries.
        found.append(np.arange(len(self.book)))
        of = np.where((box == box[at][of]).all(axis=1), of, len(found) - 1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.concatenate(found)
        begin = np.cumsum(sizes) - sizes
        index, distance = np.zeros(n, np.int64), np.zeros(n, self.book.dtype)
        ends = np.cumsum(sizes[of])
        a = 0
        while a < n:
            done = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
            some = of[a:b]
            count = sizes[some]
            first = np.cumsum(count) - count
            entry = flat[np.arange(count.sum()) - np.repeat(first - begin[some], count)]
            gap = np.repeat(points[a:b], count, axis=0) - self.book[entry]
            d2 = (gap * gap).sum(axis=1)
            best = np.minimum.reduceat(d2, first)
            hit = np.flatnonzero(d2 == np.repeat(best, count))
            owner = np.repeat(np.arange(b - a), count)[hit]
            lead = np.unique(owner, return_index=True)[1]  # entries ascend: the first hit has the lowest index
            index[a:b], distance[a:b] = entry[hit[lead]], best
            self.evaluated += len(entry)
            a = b
        return index, distance


def _exact(length: int, parts: int, *values: np.ndarray) -> type:
    """int64 where no squared distance can pass its range, else Python integers."""
    some = [v for v in values if v.size]
    if not some:
        return np.int64
    span = max(int(v.max()) for v in some) - min(int(v.min()) for v in some)
    # Boxes reach beyond the values by less than the span of a codebook.
    return np.int64 if max(1, -(-length // parts)) * parts * (3 * span + 2) ** 2 < 1 << 62 else object


def _matrix(batch: pa.RecordBatch, at: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the given length, and their components."""
    lists = batch.column(at)
    rows = np.flatnonzero(lists.value_lengths().to_numpy() == length)
    return rows, lists.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), length)


def _assigner(books: Codebooks, length: int):
    """A function from a matrix of vectors to entries (rows x parts) and summed distances."""
    at = cuts(length, len(books))
    tables: dict[type, list[Nearest]] = {}

    def assign(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _exact(length, len(books), m, *books)
        nearest = tables.setdefault(kind, [Nearest(b.astype(kind)) for b in books])
        m = m.astype(kind)
        code, error = np.zeros((len(m), len(books)), np.int64), np.zeros(len(m), kind)
        for p, near in enumerate(nearest):
            code[:, p], distance = near(m[:, at[p] : at[p + 1]])
            error = error + distance
        return code, error

    return assign


def _summed(books: Codebooks, length: int):
    at = cuts(length, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Once a task: for every part, entry and component, how many parts and their sum."""
        assign = _assigner(books, length)
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            _, m = _matrix(batch, 0, length)
            code, _ = assign(m)
            small = m.size == 0 or max(abs(int(m.max())), abs(int(m.min()))) < 1 << 31
            for p, book in enumerate(books):
                count[p] += np.bincount(code[:, p], minlength=len(book))
                some = np.zeros(book.shape, np.int64 if small else object)
                np.add.at(some, code[:, p], m[:, at[p] : at[p + 1]] if small else m[:, at[p] : at[p + 1]].astype(object))
                total[p] += some.astype(object)
        rows = [
            (p, e, j, int(count[p][e]), str(total[p][e, j]))
            for p, book in enumerate(books)
            for e in np.flatnonzero(count[p]).tolist()
            for j in range(book.shape[1])
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "entry", "at", "n", "total"]
        )

    return run


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, Codebooks]:
    """Length of the vectors coded, and the codebooks of `vectors(vec_id, v)`: empty ones of an empty table.

    What a round sends to the driver is one row for every component of every entry.
    """
    start = first_vectors(vectors, entries)
    if not start:
        return 0, [np.zeros((0, 0), np.int64)] * parts
    length = len(start[0])
    at = cuts(length, parts)
    m = np.array(start, np.int64).reshape(len(start), length)
    books = [m[:, at[p] : at[p + 1]].copy() for p in range(parts)]
    for _ in range(rounds):
        sums = vectors.select("v").mapInArrow(_summed(books, length), "part int, entry int, at int, n long, total string")
        sums = sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        for r in sums.collect():
            books[r["part"]][r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return length, books


def digest(books: Codebooks) -> str:
    """Of all components, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def coded(rows: DataFrame, length: int, books: Codebooks) -> DataFrame:
    """`rows(vec_id, v, ...)` with `code`, two hex digits a part, and `error` in place of `v`."""
    at = rows.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigner(books, length)
        for batch in batches:
            which, m = _matrix(batch, at, length)
            code, error = assign(m)
            codes: list[str | None] = [None] * batch.num_rows
            errors: list[int | None] = [None] * batch.num_rows
            for i, c, e in zip(which.tolist(), code.tolist(), error.tolist(), strict=True):
                codes[i], errors[i] = "".join(f"{x:02x}" for x in c), min(e, _LONG)
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=[*names, "code", "error"]
            )

    kept = rows.drop("v")._jdf.schema().toDDL()
    return rows.mapInArrow(run, f"{kept}, code string, error long")


def decoded(codes: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """`codes(vec_id, code)` with the vector `v` of the entries that each code names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [
                None if c is None else [int(x) for p, b in enumerate(books) for x in b[int(c[2 * p : 2 * p + 2], 16)]]
                for c in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.int64()))], names=["vec_id", "v"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id long, v array<long>")


def with_label_error(spark: SparkSession, codes: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`codes(label, error, ...)` with `label_error`, the errors summed over equal labels.

    The sums are broadcast if there are few labels; else both sides are dealt by label and a salt,
    so that a label on a third of the rows is spread.
    """
    whole = F.sum(F.coalesce("error", F.lit(0)).cast("decimal(38,0)"))
    cut = F.least(whole, F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    sums = store.keep(spark, codes.groupBy("label").agg(cut.alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of")
    if sums.count() <= limit:
        return codes.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    dealt = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    spread = sums.withColumn("its", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    on = F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("its"))
    return dealt.join(spread, on, "left").drop("of", "its", "salt")


def compress(
    spark: SparkSession, table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """`vec_id, code, error, label_error, codebooks_sha256` of the vectors of `table` as floor(scale * x)."""
    vectors = whole_vectors(table, id_col, vector_col, label_col, scale)
    length, books = train(vectors.select("vec_id", "v"), parts, entries, rounds)
    codes = store.keep(spark, coded(vectors, length, books), "codes")
    return with_label_error(spark, codes).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
