"""Build plus changes must equal a fresh build; replays must change nothing."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsift.operators import changes as ch
from docsift.operators import lexical
from docsift.operators.embed import HashedModel
from docsift.plans import index as ix
from docsift.plans import search as se
from docsift.session import fresh_path
from docsift.streaming import ingest, sync

SCHEMA = "id bigint, text string, tag string"
START = [(i, f"word{i % 7} common text{i}", "a") for i in range(60)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def build(spark, rows, name):
    return ix.create_index(
        frame(spark, rows), name, "id", text_col="text", model=HashedModel(16), filter_columns=["tag"], n_cells=4
    )


def state(index):
    """Everything a search can see."""
    stats = {r["term"]: r["df"] for r in index.frequencies().collect()}
    rows = sorted(tuple(r) for r in index.live("rows").select("id", "text", "tag", "_doc_len").collect())
    vectors = sorted((r["key"], tuple(r["vector"]), r["tag"]) for r in index.live("vectors").collect())
    posts = sorted(tuple(r) for r in index.live("postings").select("key", "term", "tf", "doc_len", "tag").collect())
    return rows, vectors, posts, stats, index.info["n_docs"], index.info["total_len"]


def test_sync_equals_rebuild(spark, index_name):
    index = build(spark, START, index_name)
    second = [(i, t if i % 3 else t + " changed", "b" if i % 5 == 0 else g) for i, t, g in START if i % 10 != 4]
    second += [(100 + i, f"fresh common {i}", "c") for i in range(8)]
    ix.sync(index, frame(spark, second))
    third = [r for r in second if r[0] != 100] + [(4, "back again", "z"), (500, "", "z"), (501, None, None)]
    ix.sync(index, frame(spark, third))
    fresh = build(spark, third, index_name + "_fresh")
    assert index.version == 2
    assert state(index) == state(fresh)
    reopened = ix.get_index(spark, index_name)
    assert state(reopened) == state(fresh)
    hits = [
        [tuple(r) for r in se.similarity_search(i, "common changed fresh", ["tag"], 10, mode, fusion_depth=50).orderBy("rank").collect()]
        for i in (reopened, fresh)
        for mode in (None, "full_text", "hybrid")
    ]
    assert hits[:3] == hits[3:]
    assert state(ix.compact(index, index_name + "_compact")) == state(fresh)


def test_nothing_to_do_keeps_the_version(spark, index_name):
    index = build(spark, START, index_name)
    before = state(index)
    ix.sync(index, frame(spark, START))
    assert index.version == 0 and state(index) == before


def test_failed_sync_is_written_again(spark, index_name, monkeypatch):
    index = build(spark, START, index_name)
    before = state(index)
    later = START[5:] + [(900, "late word1", "n")]

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ix, "_write_vectors", fail)
    with pytest.raises(RuntimeError):
        ix.sync(index, frame(spark, later))
    monkeypatch.undo()
    reopened = ix.get_index(spark, index_name)
    assert state(reopened) == before
    ix.sync(reopened, frame(spark, later))
    assert state(reopened) == state(build(spark, later, index_name + "_fresh"))


def test_replayed_batch_changes_nothing(spark, index_name):
    index = build(spark, START, index_name)
    batch = spark.createDataFrame([("put", 1, "new one", "q"), ("delete", 2, None, None)], f"op string, {SCHEMA}")
    ix.apply_changes(index, batch, "s", 0)
    after = state(index)
    ix.apply_changes(index, batch, "s", 0)
    assert index.version == 1 and state(index) == after
    ix.apply_changes(ix.get_index(spark, index_name), batch, "s", 1)
    again = ix.get_index(spark, index_name)
    assert again.version == 2 and state(again) == after


def test_two_changes_of_a_key_in_one_batch_are_refused(spark, index_name):
    index = build(spark, START, index_name)
    batch = spark.createDataFrame([("put", 1, "x", "q"), ("delete", 1, None, None)], f"op string, {SCHEMA}")
    with pytest.raises(ValueError, match="not a primary key"):
        ix.apply_changes(index, batch)


def test_stream_of_changes(spark, index_name):
    index = build(spark, START, index_name)
    schema = f"op string, {SCHEMA}, seq int, at timestamp_ntz"
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    first = [("put", 1, "one", "s", 1), ("delete", 1, None, None, 2), ("put", 1, "one back", "s", 3), ("delete", 3, None, None, 1)]
    second = [("put", 1, "one back", "s", 3), ("put", 777, "extra", "s", 1)]
    for rows in (first, second):
        at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        df = spark.createDataFrame(rows, f"op string, {SCHEMA}, seq int").withColumn("at", at)
        df.coalesce(1).write.mode("append").parquet(inbox)
        for _ in range(2):
            stream = ingest.file_stream(spark, inbox, schema, files_per_trigger=1)
            unique = sync.without_resends(stream, ["id", "seq"], "at", "1 hour")
            sync.continuous_sync(index, unique, ["seq"], progress, once=True).awaitTermination()
    want = {r[0]: r for r in START if r[0] not in (1, 3)}
    want[1], want[777] = (1, "one back", "s"), (777, "extra", "s")
    assert state(index) == state(build(spark, sorted(want.values()), index_name + "_fresh"))


def test_snapshot_diff_sees_nulls(spark):
    old = frame(spark, [(1, "a", None), (2, None, "a"), (3, "x", "y"), (4, "p", "q")])
    new = frame(spark, [(1, None, "a"), (2, None, "a"), (4, "p", "r"), (5, "n", None)])
    diff = ch.snapshot_diff(old, new, "id", ["text", "tag"])
    assert {(r["id"], r["op"]) for r in diff.collect()} == {(1, "update"), (3, "delete"), (4, "update"), (5, "insert")}
    applied = {tuple(r) for r in ch.apply_changes(old, diff, "id").collect()}
    assert applied == {tuple(r) for r in new.collect()}


def test_key_faults(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    assert {(r["key"], r["n"]) for r in ch.key_faults(df, "id").collect()} == {(1, 2), (None, 1)}
    with pytest.raises(ValueError):
        ch.require_key(df, "id")


def test_source_table_needs_its_change_feed(spark, index_name):
    from docsift.sources import tables

    tables.overwrite(frame(spark, START), index_name + "_src")
    with pytest.raises(ValueError, match="no change feed"):
        ix.create_index(spark.table(index_name + "_src"), index_name, "id", text_col="text", source_table=index_name + "_src")
    tables.enable_change_feed(spark, index_name + "_src")
    made = ix.create_index(spark.table(index_name + "_src"), index_name, "id", text_col="text", source_table=index_name + "_src")
    assert made.describe().first()["n_docs"] == len(START)


def test_a_late_change_loses_against_a_newer_one_of_an_earlier_batch(spark, index_name):
    index = build(spark, START, index_name)

    def change(key, op, text, seq):
        return spark.createDataFrame([(key, op, text, "t", seq)], "id int, op string, text string, tag string, seq int")

    columns = index.info["columns"]
    named = lambda df: df.select("op", "seq", *[F.col(a).alias(b) for a, b in zip(("id", "text", "tag"), columns)])
    steps = [(1, "put", "newest", 5), (1, "put", "late", 2), (2, "delete", None, 7), (2, "put", "too late", 6), (2, "put", "back", 8)]
    for number, step in enumerate(steps):
        ix.apply_changes(index, named(change(*step)), "s", number, ["seq"])
    key, text = columns[0], columns[1]
    found = {r[key]: r[text] for r in index.live("rows").filter(F.col(key).isin(1, 2)).collect()}
    assert found == {1: "newest", 2: "back"}
    again = ix.compact(index, index_name + "_compact")
    ix.apply_changes(again, named(change(1, "put", "late again", 3)), "s", 99, ["seq"])
    assert again.live("rows").filter(F.col(key) == 1).first()[text] == "newest"


def read_tables(df):
    """Names of the catalog tables that a plan scans, with the columns read."""
    import re

    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"FileScan parquet spark_catalog\.\w+\.(\w+)\[([^\]]*)\]", plan)


def test_digest_trees_find_what_differs(spark):
    from docsift.operators import digests as dg

    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN id END AS v")
    later = rows.filter("id <> 77").unionByName(spark.createDataFrame([(9001, 5), (9002, None)], "id long, v long"))
    later = later.withColumn("v", F.when(F.col("id") == 4242, -1).otherwise(F.col("v")))

    def tree(df, parts=None):
        marked = df.withColumn("mark", dg.mark_of(df, "id", ["v"]))
        found = dg.levels(dg.leaves(marked, dg.leaf_of(F.col("id"), 3000)))
        return dg.tree(found if parts is None else found.unionByName(parts))

    assert dg.differing(tree(rows), tree(rows.repartition(7))) is None
    leaf = lambda ids: {r[0] for r in spark.createDataFrame([(i,) for i in ids], "id long").select(dg.leaf_of(F.col("id"), 3000)).collect()}
    assert {r[0] for r in dg.differing(tree(rows), tree(later)).collect()} == leaf([77, 9001, 9002, 4242])
    # What is taken away and put in moves the one tree to the other.
    moved = spark.createDataFrame([(77, 77, -1), (4242, None, -1), (9001, 5, 1), (9002, None, 1), (4242, -1, 1)], "id long, v long, d int")
    moved = moved.withColumn("v", F.when((F.col("id") == 77) | ((F.col("id") == 4242) & (F.col("d") == -1)), F.when(F.col("id") % 3 > 0, F.col("id"))).otherwise(F.col("v")))
    signed = moved.withColumn("mark", dg.mark_of(moved, "id", ["v"]))
    parts = dg.levels(dg.leaves(signed, dg.leaf_of(F.col("id"), 3000), "mark", F.col("d")))
    assert dg.differing(tree(rows, parts), tree(later)) is None
    assert {r[0] for r in dg.differing(tree(rows.limit(0)), tree(later.filter("id = 77 OR id = 5"))).collect()} == leaf([5])


def test_a_sync_reads_only_what_differs(spark, index_name, monkeypatch):
    """One changed row: its shard of the rows is read, postings and vectors of other rows are not."""
    monkeypatch.setattr(ix, "ROWS_PER_SHARD", 8)
    index = build(spark, START, index_name)
    assert index.info["n_shards"] == 8
    later = [(i, t + " changed" if i == 17 else t, g) for i, t, g in START]
    changes = ix.changes_since(index, frame(spark, later))
    assert [r["op"] for r in changes.collect()] == ["update"]
    shard = index.live("rows").filter("id = 17").first()["_shard"]
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert f"_shard#" in plan and f"({shard})" in plan.replace(f"IN ({shard})", f"({shard})").replace(f"= {shard})", f"({shard})")
    scans, real = [], ix.counted

    def seen(session, df, label):
        scans.extend(read_tables(df))
        return real(session, df, label)

    monkeypatch.setattr(ix, "counted", seen)
    monkeypatch.setattr(ix, "written", lambda session, df, label: (scans.extend(read_tables(df)), real(session, df, label)[0])[1])
    appended, write = [], ix._append

    def noted(idx, df, part, *args, **more):
        appended.append((part, df.count()))
        scans.extend(read_tables(df))
        write(idx, df, part, *args, **more)

    monkeypatch.setattr(ix, "_append", noted)
    ix.sync(index, frame(spark, later))
    monkeypatch.undo()
    assert scans and not [t for t, _ in scans if t.endswith(("__postings", "__vectors"))]
    sizes = dict(appended)
    assert sizes["rows"] == sizes["vectors"] == sizes["changed"] == 1 and sizes["postings"] == 4
    assert sizes["terms"] == 1 and sizes["digests"] == 3
    assert state(index) == state(build(spark, later, index_name + "_fresh"))


def test_an_index_follows_another(spark, index_name):
    original, copy = build(spark, START, index_name + "_a"), build(spark, START[:40], index_name + "_b")
    ix.sync(copy, original)
    assert state(copy) == state(original)
    later = [r for r in START if r[0] % 9] + [(700, "a new one", "n")]
    ix.sync(original, frame(spark, later))
    changes = ix.changes_since(copy, original)
    assert {(r["id"], r["op"]) for r in changes.collect()} == {(i, "delete") for i, *_ in START if i % 9 == 0} | {(700, "insert")}
    ix.sync(copy, original)
    assert ix.changes_since(copy, original) is None and state(copy) == state(original)


def test_types_of_the_source_do_not_matter(spark, index_name):
    index = build(spark, START, index_name)
    narrow = frame(spark, START).withColumn("id", F.col("id").cast("int"))
    assert ix.changes_since(index, narrow) is None
    empty = build(spark, [], index_name + "_none")
    ix.sync(empty, narrow)
    assert state(empty) == state(index)
    ix.sync(empty, narrow.limit(0))
    assert empty.info["n_docs"] == 0 and empty.live("rows").count() == 0


def test_frequency_changes_are_summed_where_rows_are_tokenised(spark, monkeypatch):
    """One row per term and step, not per posting; steps of any size give the same sums."""
    texts = [("a b a", 1), ("b c", 1), (None, 1), ("", -1), ("B d", -1), ("e", -1), ("e f", 1)]
    docs = spark.createDataFrame(texts, "text string, d int").coalesce(1)
    monkeypatch.setattr(lexical, "_DOCS_PER_STEP", 1)
    small = lexical.frequency_changes(docs, "text", "d")
    monkeypatch.undo()
    whole = lexical.frequency_changes(docs, "text", "d")
    assert small.dtypes == whole.dtypes == [("term", "string"), ("df", "bigint")]
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, whole.collect())) == [("a", 1), ("b", 1), ("c", 1), ("d", -1), ("f", 1)]
    lines = pa.RecordBatch.from_pydict({"line": ["a b a", "b c"] * 500, "sign": [1] * 1000})
    assert sum(b.num_rows for b in lexical._signed_frequencies(iter([lines]))) == 6  # two steps of 512


def test_tasks_write_postings_as_files_of_the_table(spark, index_name, monkeypatch):
    """Files of one bucket each, by term, are moved into the table: rows do not go back to Spark to be sorted and written."""
    import glob
    import os

    monkeypatch.setattr(ix, "DOCS_PER_BUCKET", 8)
    monkeypatch.setattr(lexical, "TEXT_PER_FILE", 120)
    plans, write = [], ix._append

    def noted(idx, df, part, *args, **more):
        if part == "postings":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(idx, df, part, *args, **more)

    monkeypatch.setattr(ix, "_append", noted)
    words = ["b a b", "Ä b", None, "", "c a", "zebra b c"]
    rows = [(i, f"{words[i % 6]} x{i % 11}" if words[i % 6] else words[i % 6], None if i % 7 == 0 else "g") for i in range(90)]
    index = ix.create_index(frame(spark, rows), index_name, "id", text_col="text", filter_columns=["tag"], positions=True)
    assert index.info["n_buckets"] == 12
    later = [(i, t + " new" if t and i % 2 else t, g) for i, t, g in rows if i % 5]
    ix.sync(index, frame(spark, later))
    monkeypatch.undo()
    assert len(plans) == 3 and not any("MapInArrow" in p for p in plans[1:])  # the first makes the empty table
    got = index.live("postings").drop("_seg")
    want = lexical.postings(frame(spark, later), "id", "text", ["tag"], positions=True)
    shown = lambda df: sorted(df.collect(), key=lambda r: (r["key"], r["term"]))
    assert shown(got) == shown(want)
    assert shown_terms(index.frequencies()) == shown_terms(lexical.document_frequency(want))
    bucket = F.pmod(F.hash("key"), F.lit(12)).alias("b")
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {index.table('postings')}").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    files = glob.glob(f"{root}/_seg=0/*.parquet")
    assert len(files) > 12 and not [f for f in os.listdir(root) if f.startswith(".files-")]
    for file in files:
        held = spark.read.parquet(file).select(bucket, "term").collect()
        assert {r["b"] for r in held} == {int(file.split("_")[-1].split(".")[0])}
        assert [r["term"] for r in held] == sorted(r["term"] for r in held)


def shown_terms(df):
    return sorted(map(tuple, df.collect()))


def test_postings_with_a_column_that_spark_alone_writes(spark, index_name):
    rows = frame(spark, START).withColumn("tags", F.array("tag"))
    index = ix.create_index(rows, index_name, "id", text_col="text", filter_columns=["tags"])
    want = lexical.postings(rows, "id", "text", ["tags"])
    assert shown_terms(index.live("postings").drop("_seg")) == shown_terms(want)
    assert shown_terms(index.frequencies()) == shown_terms(lexical.document_frequency(want))
