"""Near-duplicate documents: SetSketch candidates, likelihood, exact verification.

Two documents are linked if their sets of word shingles have a Jaccard similarity of at
least `percent` / 100; groups are the connected components.

1. Rows with equal sets form a class, named by its smallest id; from here on a class
   stands for its copies.
2. Bands of SetSketch registers propose candidates: a link is missed with a chance below
   2e-6 at a similarity of 0.8, and less above.
3. Of the sets of candidates, shingles that no other candidate has cannot be shared, which
   bounds every intersection (`cap`) and settles most candidates alone.
4. In each bucket the members are compared with the smallest one only: first the joint
   likelihood of the registers, then the full sets.
5. What is left are pairs in different components. Inside a cluster of likely links,
   blocks of bounded size are compared in one product per pair of blocks, leaving out
   blocks that are wholly in one component; only links come out. Pairs of one bucket in
   different clusters, which are few, are verified one by one.

No bucket, class or cluster is gathered whole, and none is cut. Rows without words (null
or blank text) and rows without id are alone; a null id has a null component and is kept.
Texts that share an id are one node if the id names their classes. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import setsketch, store
from docsift.llm.components import components
from docsift.llm.shingles import set_key, shingle_sets
from docsift.session import small_side

ROWS, BANDS, REGISTERS = 5, 34, 173  # REGISTERS: the next prime
PER_BLOCK = 256  # members of a block
FEW_IDS = 2_000_000  # ids that may be sent to every task: 16 bytes each
TEXTS = 1 << 22  # characters of texts worked on at a time


def _grouped(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > TEXTS:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def _signatures(words: int, with_sets: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _grouped(texts):
                sets = list(shingle_sets(texts[a:b], words))
                keys = [set_key(s) for s in sets]
                sketch = setsketch.registers(sets, REGISTERS).astype("<u2")
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([r.tobytes() for r in sketch], pa.binary()),
                ]
                names = ["doc_id", "size", "key", "key2", "registers"]
                if with_sets:
                    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(ends, np.concatenate(sets).astype(np.int64)))
                    names.append("shingles")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


SIGNATURE = "doc_id long, size long, key long, key2 long, registers binary"


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Set size, 128-bit key of the set and registers of every text."""
    return docs.select("doc_id", "text").mapInArrow(_signatures(words, False), SIGNATURE)


def _bands(classes: DataFrame) -> DataFrame:
    """One row a class and band: the bucket it falls into."""
    width = 2 * ROWS
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    slices = classes.select("rep", "key", "size", "registers", band.alias("band"))
    bucket = F.xxhash64("band", F.expr(f"substring(registers, band * {width} + 1, {width})"))
    return slices.select(bucket.alias("bucket"), "rep", "key", "size")


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}

            def matrix(name, column=column):
                joined = b"".join(column[name].to_pylist())
                return np.frombuffer(joined, "<u2").reshape(-1, REGISTERS)

            r1, r2 = matrix("r1"), matrix("r2")
            n1, n2 = column["n1"].to_numpy(), column["n2"].to_numpy()
            parts = [slice(i, i + 2000) for i in range(0, len(r1), 2000)]
            possible = [setsketch.similarity(r1[x], r2[x], n1[x], n2[x], percent / 100)[1] for x in parts]
            keep = pa.array(np.concatenate(possible))
            yield pa.RecordBatch.from_arrays([column[n].filter(keep) for n in PAIR], names=PAIR)

    return run


PAIR = ["a", "key_a", "b", "key_b"]


def _sided(sets: DataFrame, side: str, number: int, *more: str) -> DataFrame:
    """`sets` as one side of pairs."""
    columns = {"registers": "r", "size": "n", "shingles": "s", "cap": "c"}
    return sets.select(
        F.col("rep").alias(side), F.col("key").alias(f"key_{side}"), *(F.col(m).alias(f"{columns[m]}{number}") for m in more)
    )


class _Search:
    def __init__(self, spark: SparkSession, sets: DataFrame, percent: int):
        self.spark, self.sets, self.percent = spark, sets, percent

    def can_link(self, c1: str, c2: str, n1: str, n2: str):
        """The most that two sets can share is enough: percent of the union, by whole numbers."""
        share = F.least(c1, c2)
        return (100 + self.percent) * share >= self.percent * (F.col(n1) + F.col(n2))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose registers leave a link possible."""
        sides = pairs.join(_sided(self.sets, "a", 1, "registers", "size"), ["a", "key_a"])
        sides = sides.join(_sided(self.sets, "b", 2, "registers", "size"), ["b", "key_b"])
        return sides.select(*PAIR, "r1", "r2", "n1", "n2").mapInArrow(
            _likely(self.percent), "a long, key_a long, b long, key_b long"
        )

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough, as edges."""
        sides = pairs.join(_sided(self.sets, "a", 1, "shingles", "size"), ["a", "key_a"])
        sides = sides.join(_sided(self.sets, "b", 2, "shingles", "size"), ["b", "key_b"])
        both = F.size(F.array_intersect("s1", "s2"))
        return sides.where(100 * both >= self.percent * (F.col("n1") + F.col("n2") - both)).select("a", "b")


def _caps(sets: DataFrame) -> DataFrame:
    """`rep, key, size, cap`: how many of its shingles a candidate may share with another one."""
    each = sets.select("rep", "key", F.explode("shingles").alias("s"))
    alone = each.groupBy("s").agg(F.count("*").alias("n"), F.min(F.struct("rep", "key")).alias("of")).where("n = 1")
    own = alone.groupBy("of.rep", "of.key").agg(F.count("*").alias("alone"))
    return sets.select("rep", "key", "size").join(own, ["rep", "key"], "left").select(
        "rep", "key", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("cap")
    )


def _block_links(percent: int):
    """Links between members of different components in a pair of blocks, one for each
    pair of components, from products of membership matrices."""

    def run(table: pa.Table) -> pa.Table:
        rep, comp = (table.column(n).to_numpy() for n in ("rep", "component"))
        first = np.flatnonzero(table.column("side").to_numpy() == 0)
        second = np.flatnonzero(table.column("side").to_numpy() == 1)
        second = second if len(second) else first
        lists = table.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        _, code, count = np.unique(lists.values.to_numpy()[lists.offsets[0].as_py() :], return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sizes)), sizes)
        shared = count[code] > 1
        row, code = row[shared], code[shared]
        _, code = np.unique(code, return_inverse=True)
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        both = np.zeros((len(first), len(second)), np.float32)
        width = 4096
        for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
            a, b = np.searchsorted(code, [low, low + width])
            member = np.zeros((len(sizes), width), np.float32)
            member[row[a:b], code[a:b] - low] = 1
            both += member[first] @ member[second].T
        both = both.astype(np.int64)
        total = sizes[first][:, None] + sizes[second][None, :]
        ok = (100 * both >= percent * (total - both)) & (comp[first][:, None] != comp[second][None, :])
        i, j = np.nonzero(ok)
        pairs = {(comp[first[x]], comp[second[y]]): (rep[first[x]], rep[second[y]]) for x, y in zip(i, j, strict=True)}
        found = list(pairs.values())
        return pa.table(
            {"a": pa.array([int(p[0]) for p in found], pa.int64()), "b": pa.array([int(p[1]) for p in found], pa.int64())}
        )

    return run


def _inside(search: _Search, members: DataFrame) -> DataFrame:
    """Links inside clusters, between components, by pairs of blocks.
    `members`: rep, key, cluster, component."""
    spark = search.spark
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    sizes = store.keep(spark, sizes, "cluster-sizes")
    small = sizes.where(f"n <= {PER_BLOCK}").groupBy("cluster").agg(F.sum("n").alias("n_small"))
    mixed = sizes.groupBy("cluster").agg(F.count("*").alias("parts")).where("parts > 1")
    of = sizes.join(mixed, "cluster").join(small, "cluster", "left")
    is_small = F.col("n") <= PER_BLOCK
    packs = F.ceil(F.coalesce("n_small", F.lit(0)) / PER_BLOCK)
    whose = F.when(is_small, F.lit(-1)).otherwise(F.col("component"))
    chunk = F.when(is_small, F.pmod(F.xxhash64("component"), packs)).otherwise(
        F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / PER_BLOCK))
    )
    placed = members.join(of, ["cluster", "component"]).select(
        "rep", "key", "cluster", "component", whose.alias("whose"), chunk.alias("chunk")
    )
    placed = store.keep(spark, placed, "cluster-blocks")
    blocks = placed.select("cluster", F.struct("whose", "chunk").alias("block")).distinct()
    one = blocks.withColumnRenamed("block", "x")
    two = blocks.withColumnRenamed("block", "y")
    # Two blocks of one large component have nothing to find; a block of small ones has.
    pairs = one.join(two, "cluster").where("x <= y AND (x.whose <> y.whose OR x.whose = -1)")
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("block")),
                              F.struct(F.lit(1).alias("side"), F.col("y").alias("block")))).alias("part")
    wanted = pairs.select("cluster", "x", "y", sides).where("part.side = 0 OR x <> y")
    wanted = wanted.select(
        "cluster", "x", "y", F.col("part.side").alias("side"), F.col("part.block.whose").alias("whose"),
        F.col("part.block.chunk").alias("chunk"),
    )
    rows = placed.join(search.sets.select("rep", "key", "shingles"), ["rep", "key"])
    rows = rows.join(wanted, ["cluster", "whose", "chunk"])
    return (
        rows.select("cluster", "x", "y", "side", "rep", "component", "shingles")
        .groupBy("cluster", "x", "y")
        .applyInArrow(_block_links(search.percent), "a long, b long")
    )


def links(spark: SparkSession, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """`node, component` of classes that are linked with another one."""
    bands = _bands(classes)
    shared = bands.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    buckets = store.keep(spark, bands.join(shared.select("bucket"), "bucket"), "buckets")
    chosen = store.keep(spark, buckets.select("rep", "key").distinct(), "candidates")
    n_chosen = chosen.count()
    ids = chosen.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.join(F.broadcast(ids) if n_chosen <= FEW_IDS else ids, "doc_id", "left_semi")
    sets = texts.select("doc_id", "text").mapInArrow(_signatures(words, True), f"{SIGNATURE}, shingles array<long>")
    sets = sets.where("size > 0").withColumnRenamed("doc_id", "rep").drop("key2")
    sets = store.keep(spark, sets.dropDuplicates(["rep", "key"]), "candidate-sets")
    return _resolved(spark, _Search(spark, sets, percent), buckets, n_chosen)


def _resolved(spark: SparkSession, search: _Search, buckets: DataFrame, n_chosen: int) -> DataFrame:
    caps = store.keep(spark, _caps(search.sets), "caps")
    p = search.percent
    # The partner that asks least is the smallest that a link allows.
    able = caps.where((100 + p) * F.col("cap") >= p * (F.col("size") + F.ceil(p * F.col("size") / 100)))
    live = store.keep(spark, buckets.drop("size").join(small_side(able, n_chosen), ["rep", "key"]), "live-buckets")
    hubs = live.groupBy("bucket").agg(F.min(F.struct("rep", "key", "size", "cap")).alias("hub"))
    stars = live.join(hubs, "bucket").where("rep > hub.rep").where(
        search.can_link("cap", "hub.cap", "size", "hub.size")
    )
    stars = stars.select(
        F.col("rep").alias("a"), F.col("key").alias("key_a"), F.col("hub.rep").alias("b"), F.col("hub.key").alias("key_b")
    ).distinct()
    likely = store.keep(spark, search.likely(stars), "likely-pairs")
    found = store.keep(spark, search.linked(likely), "links")

    component = store.keep(spark, components(spark, found), "components")
    cluster = components(spark, likely).withColumnRenamed("component", "cluster")
    # Both name members of `able` only, so they are few if those are.
    nodes = live.select("rep", "key", "size", "cap").distinct()
    nodes = nodes.join(small_side(component.withColumnRenamed("node", "rep"), n_chosen), "rep", "left").join(
        small_side(cluster.withColumnRenamed("node", "rep"), n_chosen), "rep", "left"
    )
    nodes = store.keep(
        spark,
        nodes.withColumns({"component": F.coalesce("component", "rep"), "cluster": F.coalesce("cluster", "rep")}),
        "nodes",
    )
    nodes = store.packed(nodes, n_chosen)
    inside = _inside(search, nodes.select("rep", "key", "cluster", "component"))

    places = live.select("bucket", "rep", "key").join(nodes, ["rep", "key"])
    several = places.groupBy("bucket").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).where("low < high")
    places = store.keep(spark, places.join(several.select("bucket"), "bucket"), "open-buckets")
    names = ["rep", "key", "size", "cap", "cluster"]
    left = places.select("bucket", *(F.col(n).alias(f"{n}1") for n in names))
    right = places.select("bucket", *(F.col(n).alias(f"{n}2") for n in names))
    across = left.join(
        right,
        (left.bucket == right.bucket)
        & (F.col("rep1") > F.col("rep2"))
        & (F.col("cluster1") != F.col("cluster2"))
        & search.can_link("cap1", "cap2", "size1", "size2"),
    )
    across = across.select(
        F.col("rep1").alias("a"), F.col("key1").alias("key_a"), F.col("rep2").alias("b"), F.col("key2").alias("key_b")
    ).distinct()
    more = store.keep(spark, inside.unionByName(search.linked(search.likely(across))), "more-links")
    if more.isEmpty():
        return component
    rest = component.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    return store.keep(spark, components(spark, rest.unionByName(more)), "components")


def groups(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of `docs(doc_id, text)`: `doc_id, n_shingles, component_id, kept`."""
    signed = store.keep(spark, signatures(docs, words), "signatures")
    known = signed.where("size > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("key", "key2", "size").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("registers").alias("registers")
    )
    classes = store.keep(spark, classes, "classes")
    linked = links(spark, docs, classes, words, percent).withColumnRenamed("node", "rep")
    named = classes.drop("registers").join(linked, "rep", "left")
    # Rows of all other classes are alone.
    named = named.where("copies > 1 OR component IS NOT NULL").select(
        "key", "key2", "size", F.coalesce("component", "rep").alias("component")
    )
    rows = signed.drop("registers").join(named, ["key", "key2", "size"], "left")
    component = F.coalesce("component", "doc_id")
    return rows.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_copies(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs`, all columns, without those that `groups` does not keep."""
    gone = groups(spark, store.text_of(docs), words, percent).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    key = F.col(f"c{store.place(docs, 'doc_id')}")
    return store.numbered(docs).join(gone, key == F.col("gone"), "left_anti").toDF(*docs.columns)
