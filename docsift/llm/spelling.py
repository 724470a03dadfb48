"""Spelling variants: words one edit apart, grouped under the form that is written far more often.

Words are runs of Latin letters with at least `MIN_LENGTH` code points and `MIN_COUNT` occurrences. Two words are near if one
inserted, deleted or replaced letter turns one into the other. A word's form is its most frequent near word (ties: the
smallest in code-point order), if that is `RATIO` times as frequent; its root is where the forms lead.

Near words are found over their letter counts. An edit changes these by an L1 distance of 2 at most: a replacement takes one
letter away and adds one, an insertion adds one. So for each pair of lengths (n, n) and (n, n + 1) the words of the second are kept in
k-d trees, and the words of the first search the box of that radius: a subtree is left out if its box needs more than
one letter added or more than one taken away (none, for an insertion). What is left is compared letter by letter.

- The upper levels of the trees are planned on the driver from a sample of `SAMPLE` words at most (the smallest hashes), so that a leaf holds
  about `BLOCK` words. All words are then placed, and every word is sent to the leaves whose boxes its search meets.
- A leaf and its searches may outgrow the plan (many words of the same letters). They are counted, and a leaf with more
  words than `BLOCK` letters allow is dealt into slices by hash, a leaf with more searches into chunks; every
  chunk meets every slice.
- A task reads its slice, builds the lower levels of the tree, and then streams the searches past it. It sends per word how
  many near words it found and the best of them, not the pairs.

Roots spread downwards from words without form, a join a level; a level multiplies the count by RATIO, so there are few.

Null and empty texts have no words, nor have runs of other letters; very long texts and words are taken whole. Repeated rows count again. A null id
is written as the empty string. Empty tables give no words. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import store

MIN_LENGTH, MIN_COUNT, RATIO, EVERY = 6, 5, 5, 199
LETTERS = 26 + 64  # a-z, and U+00C0 to U+00FF
SAMPLE, BLOCK, SEARCHES = 65_536, 8192, 131_072
LEAF = 24  # words in a leaf of the lower levels
PAIRS = 1 << 20  # letters compared at a time
TOGETHER = 1 << 18  # letters of the searches that go through a tree at a time

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(docs: DataFrame, every: int | None = EVERY, min_length: int = MIN_LENGTH) -> DataFrame:
    """`word` of every occurrence in `docs(doc_id, text)`, if long enough.

    Of runs whose crc32 with the id is a multiple of `every` one letter is deleted: misspellings that are
    known and evenly spread. Runs are filtered by length before, since nothing makes them longer.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"([A-Za-z\u00C0-\u00FF]+)"))).alias("run"))
    runs = runs.where(F.length("run") >= min_length)
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _UPPER.lower())).otherwise(F.col("run"))
    runs = runs.select("doc_id", low.alias("run"))
    if every is None:
        return runs.select(F.col("run").alias("word"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.select("run", h.alias("h"))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= min_length)


def counted(occurrences: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """`word, n` of the words with enough occurrences."""
    return occurrences.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def spelled(batch_words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of code points, all of which are below 256."""
    return np.frombuffer("".join(batch_words).encode("latin-1"), np.uint8).reshape(len(batch_words), length)


def letter_counts(m: np.ndarray) -> np.ndarray:
    """How often each letter occurs in every row."""
    at = np.where(m < 0xC0, m.astype(np.int64) - ord("a"), m.astype(np.int64) - 0xC0 + 26)
    flat = at + np.arange(len(m))[:, None] * LETTERS
    return np.bincount(flat.ravel(), minlength=len(m) * LETTERS).reshape(len(m), LETTERS).astype(np.int16 if m.shape[1] < 1 << 14 else np.int64)


def divided(points: np.ndarray) -> tuple[int, int] | None:
    """A dimension and the largest count of its lower half: where the points fall apart most evenly."""
    middle = np.partition(points, len(points) // 2, axis=0)[len(points) // 2]
    best = None
    for cut in (middle - 1, middle):
        left = np.count_nonzero(points <= cut, axis=0)
        uneven = np.where((left > 0) & (left < len(points)), abs(2 * left - len(points)), len(points))
        d = int(uneven.argmin())
        if uneven[d] < len(points) and (best is None or uneven[d] < best[0]):
            best = int(uneven[d]), d, int(cut[d])
    return best and (best[1], best[2])


def walk(node, points: np.ndarray, less: int, more: int) -> Iterator[tuple[object, np.ndarray]]:
    """Leaves of a tree of `(dimension, cut, left, right)`, with the rows of `points` that reach their box
    with `less` letters taken away and `more` added at most."""
    zero = np.zeros(len(points), points.dtype)
    stack = [(node, np.arange(len(points)), zero, zero, {}, {})]
    while stack:
        node, rows, taken, added, low, high = stack.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        d, cut, left, right = node
        x = points[rows, d]
        # To the lower side the letters beyond the cut are taken away, to the upper one the missing are added; what an
        # ancestor asked of the same letter is replaced.
        t = taken + np.maximum(x - cut, 0)
        a = added + np.maximum(cut + 1 - x, 0)
        if d in high:
            t -= np.maximum(x - high[d], 0)
        if d in low:
            a -= np.maximum(low[d] - x, 0)
        lower, upper = t <= less, a <= more
        stack.append((left, rows[lower], t[lower], added[lower], low, high | {d: cut}))
        stack.append((right, rows[upper], taken[upper], a[upper], low | {d: cut + 1}, high))


class TopTree:
    """Upper levels for the words of one length; leaves are numbers."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.n = 0
        self.root = self._node(points, leaves)

    def _node(self, points: np.ndarray, leaves: int):
        split = divided(points) if leaves > 1 and len(points) > 1 else None
        if split is None:
            self.n += 1
            return self.n - 1
        d, cut = split
        lower = points[:, d] <= cut
        share = max(1, min(leaves - 1, round(leaves * float(lower.mean()))))
        return d, cut, self._node(points[lower], share), self._node(points[~lower], leaves - share)

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of every point."""
        leaf = np.zeros(len(points), np.int64)
        for at, rows in walk(self.root, points, 0, 0):
            leaf[rows] = at
        return leaf

    def meet(self, points: np.ndarray, less: int, more: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and leaves whose box a point reaches."""
        found = [(rows, np.full(len(rows), leaf, np.int64)) for leaf, rows in walk(self.root, points, less, more)]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


class Leaf:
    """Words of a leaf of the lower levels, and the box of their letter counts."""

    def __init__(self, rows: np.ndarray, points: np.ndarray):
        self.rows, self.low, self.high = rows, points.min(axis=0), points.max(axis=0)


class LowerTree:
    """A k-d tree over one slice of a leaf of the upper levels."""

    def __init__(self, spelling: np.ndarray):
        self.spelling = spelling
        self.compared = 0
        self.root = self._node(letter_counts(spelling), np.arange(len(spelling)))

    def _node(self, points: np.ndarray, rows: np.ndarray):
        split = divided(points) if len(rows) > LEAF else None
        if split is None:
            return Leaf(rows, points)
        d, cut = split
        lower = points[:, d] <= cut
        return d, cut, self._node(points[lower], rows[lower]), self._node(points[~lower], rows[~lower])

    def near(self, spelling: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row of `spelling`, row of the tree) of near words: of equal length, or longer by one in the tree."""
        asked = letter_counts(spelling)
        length = self.spelling.shape[1]
        less = 1 if spelling.shape[1] == length else 0
        for leaf, rows in walk(self.root, asked, less, 1):
            x = asked[rows]
            ok = np.maximum(x - leaf.high, 0).sum(axis=1) <= less
            rows, x = rows[ok], x[ok]
            rows = rows[np.maximum(leaf.low - x, 0).sum(axis=1) <= 1]
            step = max(1, PAIRS // (len(leaf.rows) * max(1, length)))
            for a in range(0, len(rows), step):
                some = rows[a : a + step]
                self.compared += len(some) * len(leaf.rows)
                i, j = np.nonzero(one_edit(spelling[some][:, None, :], self.spelling[leaf.rows][None]))
                if len(i):
                    yield some[i], leaf.rows[j]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words (along the last axis) differ in one letter, or by one that `b` has more."""
    n = a.shape[-1]
    if b.shape[-1] == n:
        return np.count_nonzero(a != b, axis=-1) == 1
    # As many letters as agree from the front, and the others from the back, make the shorter word.
    front = np.logical_and.accumulate(a == b[..., :n], axis=-1).sum(axis=-1)
    back = np.logical_and.accumulate((a == b[..., 1:])[..., ::-1], axis=-1).sum(axis=-1)
    return front + back >= n


def top_trees(vocabulary: DataFrame) -> dict[int, TopTree]:
    """Trees by length, from the words with the smallest hashes; leaves by the counts of all words."""
    sizes = {r["n"]: r["count"] for r in vocabulary.groupBy(F.length("word").alias("n")).count().collect()}
    some = vocabulary.orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    by_length: dict[int, list[str]] = {}
    for r in some.where(F.length("word") <= LONG).select("word").collect():
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    return {n: TopTree(letter_counts(spelled(w, n)), -(-sizes[n] // BLOCK)) for n, w in by_length.items()}


LONG = 64  # longer words have no planned levels: one leaf a length, dealt into slices if it is large


def _by_length(values: list[str]) -> Iterator[tuple[int, list[int]]]:
    rows: dict[int, list[int]] = {}
    for i, w in enumerate(values):
        rows.setdefault(len(w), []).append(i)
    yield from rows.items()


def _placed(trees: dict[int, TopTree], search: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_pylist()
            for n, rows in _by_length(values):
                take = pa.array(rows)
                own = batch.take(take)
                points = letter_counts(spelled([values[i] for i in rows], n)) if n in trees or n + 1 in trees else None
                for length in (n, n + 1) if search else (n,):
                    which, leaf = np.arange(len(rows)), np.zeros(len(rows), np.int64)
                    if length in trees and search:
                        which, leaf = trees[length].meet(points, 1 if length == n else 0, 1)
                    elif length in trees:
                        leaf = trees[length].place(points)
                    out = own.take(pa.array(which))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(which), length, np.int32)), pa.array(leaf), *out.columns],
                        names=["length", "leaf", *out.schema.names],
                    )

    return run


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `length, leaf, slice, chunk, search, word, n`, sorted: for every block first the words of the slice, then searches."""
    key, held, counts, tree = None, [], [], None

    def answer(asked: list[str], n_asked: np.ndarray) -> Iterator[pa.RecordBatch]:
        for n, rows in _by_length(asked):
            own = spelled([asked[i] for i in rows], n)
            sides: list[tuple[np.ndarray, np.ndarray]] = []
            for i, j in tree.near(own):
                sides.append((np.array(rows)[i], j))
            if not sides:
                continue
            i, j = (np.concatenate(x) for x in zip(*sides, strict=True))
            yield best(i, asked, j, held, counts)
            if n + 1 == tree.spelling.shape[1]:  # pairs of equal length are found from both ends
                yield best(j, held, i, asked, n_asked)

    def best(of: np.ndarray, words_of: list[str], other: np.ndarray, words_other: list[str], n_other: np.ndarray):
        order = np.lexsort((np.array([words_other[k] for k in other.tolist()]), -n_other[other], of))
        of, other = of[order], other[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        size = np.diff(np.r_[first, len(of)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words_of[k] for k in of[first].tolist()]),
                pa.array(size.astype(np.int64)),
                pa.array(n_other[other[first]].astype(np.int64)),
                pa.array([words_other[k] for k in other[first].tolist()]),
            ],
            names=["word", "n_near", "best_n", "best"],
        )

    waiting, of_waiting = [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if waiting:
            yield from answer(waiting, np.concatenate(of_waiting))
            waiting.clear()
            of_waiting.clear()

    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        values, n = batch.column(5).to_pylist(), batch.column(6).to_numpy()
        marks = np.column_stack([c.astype(np.int64) for c in columns])
        ends = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(values)], strict=True):
            if a == b:
                continue
            block, search = tuple(marks[a, :4].tolist()), bool(marks[a, 4])
            if block != key:
                yield from flush()
                key, held, counts, tree = block, [], np.zeros(0, np.int64), None
            if not search:
                held += values[a:b]
                counts = np.r_[counts, n[a:b]]
            elif held:
                if tree is None:
                    tree = LowerTree(spelled(held, key[0]))
                waiting += values[a:b]
                of_waiting.append(n[a:b])
                if len(waiting) * max(1, key[0]) >= TOGETHER:
                    yield from flush()
    yield from flush()


def near_words(spark: SparkSession, vocabulary: DataFrame) -> DataFrame:
    """`word, n_near, best_n, best` of the words of `vocabulary(word, n)` that have near ones."""
    trees = top_trees(vocabulary)
    schema = "length int, leaf long, word string, n long"
    placed = store.keep(spark, vocabulary.mapInArrow(_placed(trees, False), schema), "spelling-leaves")
    asked = store.keep(spark, vocabulary.mapInArrow(_placed(trees, True), schema), "spelling-searches")
    block = ["length", "leaf"]
    # A slice holds BLOCK words, fewer of very long ones.
    slices = F.ceil(F.count("*") * F.greatest(F.lit(1.0), F.col("length") / LONG) / BLOCK).cast("long")
    sizes = placed.groupBy(*block).agg(slices.alias("slices"))
    asks = asked.groupBy(*block).agg(F.ceil(F.count("*") / SEARCHES).cast("long").alias("chunks"))
    grid = store.keep(spark, sizes.join(asks, block), "spelling-grid")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one of the blocks along one side, for all along the other side."""
        one = F.pmod(F.xxhash64("word"), F.col(f"{own}s"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1))
        return rows.join(grid, block).withColumn(own, one).withColumn(other, every)

    columns = ["length", "leaf", "slice", "chunk", "search", "word", "n"]
    points = dealt(placed, "slice", "chunk").withColumn("search", F.lit(False)).select(*columns)
    searches = dealt(asked, "chunk", "slice").withColumn("search", F.lit(True)).select(*columns)
    both = points.unionByName(searches).repartition(*columns[:4]).sortWithinPartitions(*columns[:5])
    found = both.mapInArrow(_found, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return merged.select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def forms(spark: SparkSession, vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """`word, form, root, n, n_near, form_n` of the words of `vocabulary(word, n)`."""
    vocabulary = store.keep(spark, vocabulary, "vocabulary")
    both = vocabulary.join(near_words(spark, vocabulary), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    rows = both.select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    rows = store.keep(spark, rows, "forms")
    roots = rows.where("form IS NULL").select("word", F.col("word").alias("root"))
    level, parts = store.keep(spark, roots, "roots"), []
    left = rows.where("form IS NOT NULL").select("word", "form")
    while True:
        parts.append(level)
        # A form has no more variants than it has edits, so no key of this join is hot.
        above = level.select(F.col("word").alias("form"), "root")
        level = store.keep(spark, left.join(above, "form").select("word", "root"), "roots")
        if level.isEmpty():
            break
    roots = parts[0]
    for part in parts[1:]:
        roots = roots.unionByName(part)
    return rows.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")


def variants(
    spark: SparkSession, docs: DataFrame, every: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    ratio: int = RATIO, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The words of `docs` with their forms and roots; `every`: see `words`."""
    found = words(store.text_of(docs, id_col, text_col), every, min_length)
    return forms(spark, counted(found, min_count), ratio)
