"""Postings, term statistics and keyword matching."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions import tokens as tk
from docsift.functions.let import let, pieces
from docsift.session import counted, small_side


_DOCS_PER_STEP = 512
TEXT_PER_FILE = 1 << 24  # bytes of token lines that make one file of postings
_MERGED_ROWS = 1 << 21


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, _DOCS_PER_STEP):
        yield batch.slice(start, _DOCS_PER_STEP)


def _words(lines: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The tokens of token lines, and the row that each is from."""
    lists = pc.split_pattern(lines, " ")
    owner = np.repeat(np.arange(len(lines)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    words = pc.list_flatten(lists)
    full = pc.not_equal(words, "")
    return owner[full.to_numpy(zero_copy_only=False)], words.filter(full)


def _places(order: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Per pair the places of its term in the document: the first, then the steps from each to the next."""
    first_token = np.searchsorted(owner, np.arange(owner[-1] + 1))
    place = order - first_token[owner[order]]
    step = np.diff(place, prepend=0)
    starts = np.r_[0, ends[:-1]]
    step[starts] = place[starts]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(step.astype(np.int32)))


def _ordered(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of `pairs`, and them in it: sorted as one number with their place, while that fits."""
    bits = len(pairs).bit_length()
    if int(pairs.max()).bit_length() + bits > 62:
        order = np.argsort(pairs, kind="stable")
        return order, pairs[order]
    both = np.sort(pairs << bits | np.arange(len(pairs)))
    return both & ((1 << bits) - 1), both >> bits


def _posted(docs: pa.RecordBatch, positions: bool) -> tuple[pa.RecordBatch, pa.RecordBatch] | None:
    """Rows of (key, token line, carried columns) as rows of (key, term, tf, doc_len, carried, positions), by term;
    and (term, df) of them. None, if there are no tokens."""
    owner, words = _words(docs.column(1))
    if len(words) == 0:
        return None
    coded = words.dictionary_encode()
    by_term = pc.sort_indices(coded.dictionary)
    place = np.empty(len(by_term), np.int64)
    place[by_term.to_numpy()] = np.arange(len(by_term))
    pairs = place[coded.indices.to_numpy()] * docs.num_rows + owner
    order, pairs = _ordered(pairs)
    starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    ends = np.r_[starts[1:], len(pairs)]
    term, row = np.divmod(pairs[starts], docs.num_rows)
    doc_len = np.bincount(owner, minlength=docs.num_rows)[row]
    carried = [docs.column(i).take(pa.array(row)) for i in (0, *range(2, docs.num_columns))]
    terms = coded.dictionary.take(by_term)
    columns = [carried[0], terms.take(pa.array(term)), pa.array(ends - starts), pa.array(doc_len), *carried[1:]]
    if positions:
        columns.append(_places(order, owner, ends))
    df = pa.array(np.bincount(term, minlength=len(terms)))
    return (
        pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))]),
        pa.RecordBatch.from_arrays([terms, df], names=["term", "df"]),
    )


def _count_terms(positions: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of (key, token line, carried columns) to rows of (key, term, tf, doc_len, carried, positions),
        by term within some documents: a writer that sorts by term merges a few runs."""
        for whole in batches:
            for docs in _steps(whole):
                found = _posted(docs, positions)
                if found is not None:
                    yield found[0]

    return run


def _schema(slim: DataFrame, carry: list[str], positions: bool) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    return ", ".join(
        [f"key {kinds['key']}", "term string", "tf bigint", "doc_len bigint"]
        + [f"`{c}` {kinds[c]}" for c in carry]
        + (["positions array<int>"] if positions else [])
    )


def postings(
    docs: DataFrame,
    key: str,
    text_col: str,
    carry: list[str] | None = None,
    parts: int | None = None,
    positions: bool = False,
    by: Column | None = None,
) -> DataFrame:
    """One row per (key, distinct term): `key, term, tf, doc_len`, plus `carry` columns.

    Terms are counted document by document, batch by batch: nothing is grouped
    across rows, so memory does not grow with the table. With `parts` the documents
    are first spread by key (or `by`, over it), ready for a table of buckets. With `positions`,
    a last column says where the term stands: its first place, counted in tokens from 0, then the steps to the next ones.
    """
    carry = carry or []
    slim = docs.select(F.col(key).alias("key"), F.col(text_col).alias("_text"), *carry)
    spread = slim.repartition(parts, F.col("key") if by is None else by) if parts else slim
    lines = spread.select("key", tk.token_line(F.col("_text")).alias("_line"), *carry)
    return lines.mapInArrow(_count_terms(positions), _schema(slim, carry, positions))


def _gathered(batches: Iterator[pa.RecordBatch], line: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `most` bytes of the column `line`; one row at least."""
    held: list[pa.RecordBatch] = []
    size = 0

    def whole() -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    for batch in batches:
        # A row counts a little besides its text, so that rows without any are no endless batch.
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(line)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = min(int(np.searchsorted(ends, before + most - size)) + 1, batch.num_rows)
            held.append(batch.slice(at, stop - at))
            size, at = size + int(ends[stop - 1]) - before, stop
            if size >= most:
                yield from whole()
                held, size = [], 0
    if held:
        yield from whole()


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `term, df` with those of a term summed up, some rows at a time."""
    held: list[pa.RecordBatch] = []
    n = 0

    def whole() -> list[pa.RecordBatch]:
        if len(held) == 1:
            return held
        sums = pa.Table.from_batches(held).group_by("term", use_threads=False).aggregate([("df", "sum")])
        sums = sums.select(["term", "df_sum"]).rename_columns(["term", "df"])
        return sums.filter(pc.not_equal(sums.column("df"), 0)).combine_chunks().to_batches()

    for part in parts:
        held.append(part)
        n += part.num_rows
        if n >= _MERGED_ROWS:
            yield from whole()
            held, n = [], 0
    if held:
        yield from whole()


def _write_files(uri: str, names: list[str], positions: bool, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of (key, token line, carried columns, bucket) to files of postings, each of one bucket and by term, and
        rows of (file, term, df): the documents by term, and at last the files that are whole."""
        from pyarrow import fs, parquet

        system, root = fs.FileSystem.from_uri(uri)
        files: list[str] = []

        def written() -> Iterator[pa.RecordBatch]:
            for docs in _gathered(batches, 1, most):
                bucket = docs.column(docs.num_columns - 1).to_numpy(zero_copy_only=False)
                held = docs.select(range(docs.num_columns - 1))
                for b in np.unique(bucket):
                    found = _posted(held.take(pa.array(np.flatnonzero(bucket == b))), positions)
                    if found is None:
                        continue
                    # Names that nothing else has: a task that runs again leaves files that nobody names.
                    files.append(f"part-{uuid.uuid4().hex}_{b:05d}.snappy.parquet")
                    table = pa.Table.from_batches([found[0]]).rename_columns(names)
                    parquet.write_table(table, f"{root}/{files[-1]}", filesystem=system, compression="snappy")
                    yield found[1]

        for part in _merged(written()):
            yield pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.string()), *part.columns], names=["file", "term", "df"])
        none = [pa.nulls(len(files), pa.string()), pa.nulls(len(files), pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), *none], names=["file", "term", "df"])

    return run


def posting_files(
    docs: DataFrame,
    key: str,
    text_col: str,
    carry: list[str],
    uri: str,
    buckets: int,
    parts: int,
    positions: bool,
) -> tuple[DataFrame, str]:
    """Writes what `postings` gives to Parquet files below `uri` when it runs, and the schema of those files.

    Rows are `file` of the files that count, and `term, df` of their rows in parts. A file holds rows of one bucket of
    Spark's bucketing by key, by term, of some MB of text; its name ends in the bucket as Spark's own do. Files made here cost a
    fraction of rows that go back to Spark, are sorted there and written.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text_col).alias("_text"), *carry)
    bucket = F.pmod(F.hash("key"), F.lit(buckets))
    spread = slim.repartition(parts, F.col("key") if parts == buckets else bucket)
    schema = _schema(slim, carry, positions)
    names = ["key", "term", "tf", "doc_len", *carry] + (["positions"] if positions else [])
    lines = spread.select("key", tk.token_line(F.col("_text")).alias("_line"), *carry, bucket.alias("_bucket"))
    return lines.mapInArrow(_write_files(uri, names, positions, TEXT_PER_FILE), "file string, term string, df bigint"), schema


def _signed_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (token line, sign) to rows of (term, sum of the signs of the rows that hold it), step by step."""
    for whole in batches:
        for docs in _steps(whole):
            owner, words = _words(docs.column(0))
            if len(words) == 0:
                continue
            coded = words.dictionary_encode()
            held = np.sort(coded.indices.to_numpy().astype(np.int64) * docs.num_rows + owner)
            held = held[np.r_[True, held[1:] != held[:-1]]]
            sign = docs.column(1).to_numpy(zero_copy_only=False)[held % docs.num_rows]
            df = np.bincount(held // docs.num_rows, weights=sign, minlength=len(coded.dictionary)).astype(np.int64)
            moved = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(moved)), pa.array(df[moved])], names=["term", "df"])


def frequency_parts(docs: DataFrame, text_col: str, sign: Column) -> DataFrame:
    """`term, df` in parts: by how much the rows of `docs`, which count by their sign, change document frequencies.

    Rows are summed up where they are tokenised, so that what is grouped by term follows the vocabulary, not the postings.
    """
    lines = docs.select(tk.token_line(F.col(text_col)).alias("_line"), sign.cast("bigint").alias("_sign"))
    return lines.mapInArrow(lambda batches: _merged(_signed_frequencies(batches)), "term string, df bigint")


def summed(parts: DataFrame) -> DataFrame:
    """`term, df` of parts; a term that nothing is left of is none."""
    return parts.groupBy("term").agg(F.sum("df").alias("df")).filter(F.col("df") != 0)


def frequency_changes(docs: DataFrame, text_col: str, sign_col: str) -> DataFrame:
    """`term, df`: by how much the rows of `docs`, which count by their sign, change document frequencies."""
    return summed(frequency_parts(docs, text_col, F.col(sign_col)))


def places(steps: Column) -> Column:
    """Absolute places from the stored steps, ascending."""

    def add(acc: Column, piece: Column) -> Column:
        run = F.aggregate(
            piece,
            F.struct(F.array().cast("array<int>").alias("out"), acc["at"].alias("at")),
            lambda a, x: F.struct(F.concat(a["out"], F.array(a["at"] + x)).alias("out"), (a["at"] + x).alias("at")),
        )
        return let(run, lambda r: F.struct(F.concat(acc["out"], F.array(r["out"])).alias("out"), r["at"].alias("at")))

    none = F.struct(F.array().cast("array<array<int>>").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(pieces(steps), none, add, lambda acc: F.flatten(acc["out"]))


def document_frequency(posts: DataFrame) -> DataFrame:
    return posts.groupBy("term").agg(F.count("*").alias("df"))


def idf(n_docs, df):
    """ln(1 + (N - df + 0.5) / (df + 0.5))"""
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def query_terms(queries: DataFrame, text_col: str) -> DataFrame:
    """`query_id, term`, each term once per query."""
    listed = queries.select("query_id", F.explode_outer(tk.distinct_tokens(F.col(text_col))).alias("term"))
    return listed.filter(F.col("term").isNotNull())


def weighted_queries(terms: DataFrame, frequencies: DataFrame, n_docs: int) -> DataFrame:
    """`query_id, terms array<struct<term, idf>>` for terms the corpus holds."""
    met = terms.join(frequencies, "term")
    pair = F.struct("term", idf(F.lit(n_docs), F.col("df")).alias("idf"))
    return met.groupBy("query_id").agg(F.sort_array(F.collect_list(pair)).alias("terms"))


def all_terms(posts: DataFrame, frequencies: DataFrame, queries: DataFrame, query_text: str, small: bool) -> DataFrame:
    """`query_id, key, n_terms`: documents that hold all distinct terms of a query.

    Only a document with a query's rarest term can qualify, so queries meet
    documents on that term alone; the others are checked on the document's own
    terms. A query with a term the corpus lacks has no match. With `small` (checked
    by the caller) the query side is shipped and the postings stay where they are.
    """
    side = F.broadcast if small else (lambda df: df)
    asked = queries.select("query_id", tk.distinct_tokens(F.col(query_text)).alias("wanted"))
    each = asked.select("query_id", "wanted", F.explode_outer("wanted").alias("term")).filter(F.col("term").isNotNull())
    rarest = (
        each.join(frequencies, "term")
        .groupBy("query_id")
        .agg(F.min(F.struct("df", "term")).alias("r"), F.count("*").alias("known"), F.first("wanted").alias("wanted"))
        .filter(F.col("known") == F.size("wanted"))
        .select("query_id", "wanted", F.col("r.term").alias("term"))
    )
    vocabulary = each.select("term").distinct()
    held = (
        posts.select("key", "term")
        .join(side(vocabulary), "term", "left_semi")
        .groupBy("key")
        .agg(F.collect_list("term").alias("found"))
    )
    met = held.select("key", "found", F.explode("found").alias("term")).join(side(rarest), "term")
    whole = met.filter(F.size(F.array_except("wanted", "found")) == 0)
    return whole.select("query_id", "key", F.size("wanted").alias("n_terms"))


def phrases(posts: DataFrame, frequencies: DataFrame, queries: DataFrame, query_text: str, small: bool) -> DataFrame:
    """`query_id, key, n_places, first_place`: documents that hold the tokens of a query one after the other,
    how often (overlapping), and where first, counted in tokens from 0.

    From `posts` with positions, without the texts. Only documents that hold all terms are looked at; their
    position lists, shifted by the place of the term in the query, are intersected from the shortest on. A query
    without tokens has no match.
    """
    found = all_terms(posts, frequencies, queries, query_text, small).select("query_id", "key")
    met, n = counted(posts.sparkSession, found, "phrase-candidates")
    asked = queries.select("query_id", F.posexplode(tk.tokens(F.col(query_text))).alias("at", "term"))
    side = F.broadcast if small else (lambda df: df)
    # Candidates go to the buckets of their keys, where the postings of the asked terms lie and stay.
    held = posts.select("key", "term", "tf", "positions").join(side(asked.select("term").distinct()), "term", "left_semi")
    lists = held.join(small_side(met, n), "key").join(side(asked), ["query_id", "term"])
    each = lists.groupBy("query_id", "key").agg(F.array_sort(F.collect_list(F.struct("tf", "at", "positions"))).alias("lists"))

    def starts(x: Column) -> Column:
        return F.transform(places(x["positions"]), lambda p: p - x["at"])

    shared = let(
        F.col("lists"), lambda a: F.aggregate(F.slice(a, F.lit(2), F.size(a)), starts(a[0]), lambda acc, x: F.array_intersect(acc, starts(x)))
    )
    hits = each.select("query_id", "key", shared.alias("starts")).filter(F.size("starts") > 0)
    return hits.select("query_id", "key", F.size("starts").alias("n_places"), F.array_min("starts").alias("first_place"))


def phrase(text, wanted):
    """Exact phrase on token boundaries, blind to case and punctuation."""
    flat = F.concat(F.lit(" "), tk.token_line(text), F.lit(" "))
    needle = F.concat(F.lit(" "), F.trim(tk.token_line(wanted)), F.lit(" "))
    return F.contains(flat, needle)
