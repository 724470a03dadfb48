"""Chunking with column expressions: each row is cut where it lies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions import tokens as tk
from docsift.functions.let import let, pieces
from docsift.operators.clean import PAGE_MARK
from docsift.operators.embed import signed_counts

SENTENCE_MARK = "\x01"


def _check(size: int, overlap: int) -> int:
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    return size - overlap


def chunk_count(length: Column, size: int, overlap: int) -> Column:
    """1 + max(0, ceil((length - size) / stride))"""
    stride = _check(size, overlap)
    return (F.greatest(F.ceil((length - size) / stride), F.lit(0)) + 1).cast("int")


def _explode(df: DataFrame, keep: list[str], pieces: Column) -> DataFrame:
    return df.select(*keep, F.posexplode_outer(pieces).alias("pos", "chunk")).filter(F.col("chunk").isNotNull())


def char_windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of `size` characters, each starting `size - overlap` later; one, if the text is shorter.

    The text is cut once into stride-long blocks and a window joins neighbouring
    blocks, so the work is linear in the text however long it is.
    """
    stride = _check(size, overlap)
    per_window = -(-size // stride)
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    last = chunk_count(F.length(text), size, overlap) - 1

    def windows(parts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.substring(F.array_join(F.slice(parts, i + 1, F.lit(per_window)), ""), 1, size),
        )

    return let(blocks, windows)


def fixed_chars(df: DataFrame, keep: list[str], text: str, size: int, overlap: int) -> DataFrame:
    """`keep, pos, chunk`: the windows of every text that is not empty."""
    return _explode(df.filter(F.length(text) > 0), keep, char_windows(F.col(text), size, overlap))


def fixed_tokens(df: DataFrame, keep: list[str], text: str, size: int, overlap: int) -> DataFrame:
    """The same over blank-separated words."""
    stride = _check(size, overlap)

    def windows(parts: Column) -> Column:
        last = chunk_count(F.size(parts), size, overlap) - 1
        cut = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.array_join(F.slice(parts, i * stride + 1, F.lit(size)), " "),
        )
        return F.when(F.size(parts) > 0, cut)

    return _explode(df, keep, let(tk.words(F.col(text)), windows))


def _nonblank(pieces: Column) -> Column:
    trimmed = F.transform(pieces, lambda p: F.trim(p, F.lit(tk.BLANKS)))
    return F.filter(trimmed, lambda p: p != "")


def by_pages(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """One chunk per page of marked text."""
    return _explode(df, keep, _nonblank(F.split(F.col(text), PAGE_MARK.strip())))


def nonblank(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text is neither null nor blank."""
    return df.filter(F.col(text).rlike(r"\S"))


def sentences(text: Column) -> Column:
    """Array of sentences: cut after . ! ? before a blank, and at line ends."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1" + SENTENCE_MARK)
    return _nonblank(F.split(F.regexp_replace(marked, r"\n+", SENTENCE_MARK), SENTENCE_MARK))


def by_sentences(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    return _explode(df, keep, sentences(F.col(text)))


def by_paragraphs(df: DataFrame, keep: list[str], text: str, boundary: str = r"\n\s*\n") -> DataFrame:
    return _explode(df, keep, _nonblank(F.split(F.col(text), boundary)))


def packed_sentences(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Whole sentences packed up to `size` characters; a longer sentence stands alone."""

    def add(acc: Column, part: Column) -> Column:
        fits = F.length(acc["held"]) + 1 + F.length(part) <= size
        return (
            F.when(acc["held"].isNull(), F.struct(acc["out"].alias("out"), part.alias("held")))
            .when(fits, F.struct(acc["out"].alias("out"), F.concat(acc["held"], F.lit(" "), part).alias("held")))
            .otherwise(F.struct(F.concat(acc["out"], F.array(acc["held"])).alias("out"), part.alias("held")))
        )

    def start(held: Column) -> Column:
        return F.struct(F.array().cast("array<string>").alias("out"), held.alias("held"))

    def add_piece(acc: Column, piece: Column) -> Column:
        done = F.aggregate(piece, start(acc["held"]), add)
        return let(done, lambda d: F.struct(F.concat(acc["out"], F.array(d["out"])).alias("out"), d["held"].alias("held")))

    none = F.struct(F.array().cast("array<array<string>>").alias("out"), F.lit(None).cast("string").alias("held"))
    packed = F.aggregate(
        pieces(sentences(F.col(text))), none, add_piece,
        lambda acc: F.concat(F.flatten(acc["out"]), F.array_compact(F.array(acc["held"]))),
    )
    return _explode(df, [key], packed)


def by_headers(df: DataFrame, keep: list[str], text: str, depth: int = 6) -> DataFrame:
    """Sections of Markdown text with their heading path, `keep` naming one text.

    A deeper heading counts only below the last shallower one.
    """
    marked = F.regexp_replace(F.col(text), r"(?m)^(#{1,6} )", SENTENCE_MARK + "$1")
    rows = _explode(df, keep, _nonblank(F.split(marked, SENTENCE_MARK)))
    level = F.length(F.regexp_extract("chunk", r"^(#{1,6}) ", 1))
    title = F.regexp_extract("chunk", r"^#{1,6} ([^\n]*)", 1)
    upto = Window.partitionBy(*keep).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"level": level, "title": title})
    found = {
        f"_h{n}": F.last(F.when(F.col("level") == n, F.struct("pos", "title")), ignorenulls=True).over(upto)
        for n in range(1, depth + 1)
    }
    rows = rows.withColumns(found)
    parts = []
    for n in range(1, depth + 1):
        shallower = [F.coalesce(F.col(f"_h{m}.pos"), F.lit(-1)) for m in range(1, n)]
        newest = F.greatest(F.lit(-1), F.lit(-1), *shallower)
        parts.append(F.when(F.col(f"_h{n}.pos") > newest, F.col(f"_h{n}.title")))
    return rows.select(*keep, "pos", F.concat_ws(" > ", *parts).alias("heading_path"), "chunk")


def with_header(chunks: DataFrame, header: list[Column], chunk: str = "chunk", out: str = "full_chunk") -> DataFrame:
    """Put title, tags or other metadata before the chunk; the bare chunk stays."""
    return chunks.withColumn(out, F.concat(F.concat_ws(" | ", *header), F.lit("\n"), F.col(chunk)))


def _neighbour_similarity(dim: int):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def similarity(lines: pa.Array) -> pa.Array:
        lines = lines.cast(pa.list_(pa.string()))
        counts = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(lines)
        bags = signed_counts(pc.split_pattern(flat, " "), dim)
        lengths = np.sqrt((bags * bags).sum(axis=1))
        value = np.full(len(bags), np.nan)
        if len(bags) > 1:
            both = lengths[1:] * lengths[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                value[1:] = np.where(both > 0, (bags[1:] * bags[:-1]).sum(axis=1) / both, np.nan)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        firsts = offsets[:-1][counts > 0]
        value[firsts] = np.nan
        values = pa.array(np.round(value, 6), from_pandas=True)
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)

    return similarity


def semantic(df: DataFrame, keep: list[str], text: str, threshold: float, dim: int = 64) -> DataFrame:
    """Chunks of neighbouring sentences, cut where the cosine of two neighbours
    falls below `threshold`. A sentence without tokens never causes a cut."""
    listed = df.select(*keep, sentences(F.col(text)).alias("parts"))
    scored = listed.withColumn(
        "sims", _neighbour_similarity(dim)(F.transform("parts", lambda s: tk.token_line(s)))
    )

    def assemble(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda s, j: F.array_join(
                F.slice(
                    F.col("parts"),
                    s,
                    F.coalesce(F.get(starts, j + 1), F.size("parts") + 1) - s,
                ),
                " ",
            ),
        )

    cuts = F.filter(
        F.transform(
            "sims", lambda sim, i: F.when((i == 0) | F.coalesce(sim < threshold, F.lit(False)), i + 1)
        ),
        lambda s: s.isNotNull(),
    )
    return _explode(scored, keep, let(cuts, assemble))


def windowed_summary(df: DataFrame, keep: list[str], chunks: Column, reach: int = 3, summary=None) -> DataFrame:
    """Each chunk with a summary of the `reach` chunks before it.

    `summary(chunk)` is an expression; by default the chunk's first sentence.
    """
    first = summary or (lambda c: F.get(sentences(c), F.lit(0)))

    def attach(parts: Column) -> Column:
        return let(
            F.transform(parts, first),
            lambda leads: F.transform(
                parts,
                lambda c, i: F.struct(
                    c.alias("chunk"),
                    F.array_join(
                        F.slice(leads, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach))), " "
                    ).alias("before"),
                ),
            ),
        )

    return (
        df.select(*keep, F.posexplode_outer(let(chunks, attach)).alias("pos", "c"))
        .filter(F.col("c").isNotNull())
        .select(*keep, "pos", "c.before", "c.chunk")
    )


def paragraphs(text: Column, boundary: str) -> Column:
    return _nonblank(F.split(text, boundary))


def fit_report(df: DataFrame, keep: list[str], text: str, limit: int) -> DataFrame:
    """Token count against a context window, and what a cut would lose."""
    n = F.size(tk.words(F.col(text)))
    return df.select(*keep, n.alias("n_tokens")).select(
        *keep,
        "n_tokens",
        (F.col("n_tokens") <= limit).alias("fits"),
        F.greatest(F.col("n_tokens") - limit, F.lit(0)).alias("excess"),
        F.greatest(F.ceil(F.col("n_tokens") / limit), F.lit(1)).cast("int").alias("n_parts"),
    )


def fit(df: DataFrame, keep: list[str], text: str, limit: int, policy: str) -> DataFrame:
    """Bring text under `limit` tokens: 'error', 'truncate' or 'split'."""
    if policy == "split":
        return fixed_tokens(df, keep, text, limit, 0)
    parts = tk.words(F.col(text))
    if policy == "truncate":
        short = let(parts, lambda p: F.when(F.size(p) > limit, F.array_join(F.slice(p, 1, limit), " ")))
        return df.select(*keep, F.lit(0).alias("pos"), F.coalesce(short, F.col(text)).alias("chunk"))
    if policy == "error":
        over = F.raise_error(F.concat(F.lit(f"more than {limit} tokens: "), F.size(parts).cast("string")))
        return df.select(
            *keep, F.lit(0).alias("pos"), F.when(F.size(parts) > limit, over).otherwise(F.col(text)).alias("chunk")
        )
    raise ValueError(f"unknown policy {policy!r}")


def chunk_ids(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Stable ids from the keys: `chunk_id` (128 bits, text) and `id` (60 bits, bigint).

    Both depend on the row alone, not on partitioning or run. The bigint suits up
    to some hundred million chunks; beyond that collisions must be expected, and
    `chunk_id` is the key to use.
    """
    digest = F.md5(F.concat_ws("#", *[F.col(k).cast("string") for k in keys]))
    return chunks.withColumn("chunk_id", digest).withColumn(
        "id", F.conv(F.substring("chunk_id", 1, 15), 16, 10).cast("bigint")
    )


def size_study(df: DataFrame, text: str, sizes: list[tuple[int, int]]) -> DataFrame:
    """Chunk count, mean length and repeated share per (size, overlap).

    Follows from text lengths alone, so the texts are measured but never cut.
    """
    options = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(o).alias("overlap")) for s, o in sizes])
    for s, o in sizes:
        _check(s, o)
    rows = (
        df.select(F.length(text).alias("n"))
        .filter("n > 0")
        .select("n", F.explode(options).alias("o"))
        .select("n", "o.size", "o.overlap")
    )
    stride = F.col("size") - F.col("overlap")
    count = F.greatest(F.ceil((F.col("n") - F.col("size")) / stride), F.lit(0)) + 1
    totals = (
        rows.withColumn("k", count)
        .withColumn("covered", F.col("n") + (F.col("k") - 1) * F.col("overlap"))
        .groupBy("size", "overlap")
        .agg(F.sum("k").alias("n_chunks"), F.sum("covered").alias("covered"), F.sum("n").alias("n_chars"))
    )
    return totals.select(
        "size",
        "overlap",
        F.col("n_chunks").cast("bigint").alias("n_chunks"),
        F.round(F.col("covered") / F.col("n_chunks"), 6).alias("mean_chars"),
        F.round(F.col("covered") / F.col("n_chars") - 1, 6).alias("repeated_share"),
    )
