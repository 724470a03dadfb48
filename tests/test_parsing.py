import pytest
from pyspark.sql import functions as F

from docsift.operators import clean, metadata, parse
from docsift.sources import files, tables
from docsift.session import fresh_path, scratch_database

PAGE = """<!DOCTYPE html><html><head><title>T &amp; co</title><script>var t="</p><p>no";</script></head>
<body><nav><ul><li>menu</li></ul></nav><div class="ad">buy</div><div>lead</div><H1 id="x">Head</H1><p>one<p>two <b>bold</b>
<ul><li>item</li></ul><table class="x"><tr><td><div><p>cell</p></div></td></tr></TABLE>after
<figure><img src="a.png" alt="x"><figcaption>Fig 1</figcaption></figure><p>12</p><!-- <p>gone</p> -->
<footer>foot</footer><p>tail</p></body></html>"""


@pytest.fixture(scope="module")
def elements(spark):
    return parse.parse_elements(spark.createDataFrame([("p", PAGE)], "path string, html string"), "path", "html")


def test_elements(elements):
    got = [(r["type"], r["region"], r["content"]) for r in elements.orderBy("pos").collect()]
    assert got == [
        ("title", "body", "T & co"),
        ("list_item", "nav", "menu"),
        ("text", "ad", "buy"),
        ("text", "body", "lead"),
        ("header", "body", "Head"),
        ("text", "body", "one"),
        ("text", "body", "two bold"),
        ("list_item", "body", "item"),
        ("table", "table", '<table class="x"><tr><td><div><p>cell</p></div></td></tr></table>'),
        ("text", "body", "after"),
        ("image", "body", "a.png"),
        ("caption", "body", "Fig 1"),
        ("text", "body", "12"),
        ("text", "footer", "foot"),
        ("text", "body", "tail"),
    ]


def test_noise_and_captions(elements):
    kept = [r["content"] for r in parse.drop_noise(elements).orderBy("pos").collect()]
    assert not {"menu", "buy", "foot", "12"} & set(kept) and "tail" in kept
    rows = parse.attach_captions(parse.drop_noise(elements), "caption", "image").collect()
    assert [(r["content"], r["caption"]) for r in rows] == [("a.png", "Fig 1")]


def test_spans_point_into_the_text(elements):
    text = clean.plain_text(elements).first()["plain_text"]
    for r in parse.element_spans(elements).collect():
        assert text[r["start"] - 1 : r["end"]] == r["content"]
        assert r["bbox"] is None


def test_markdown(elements):
    text = clean.markdown(parse.drop_noise(elements)).first()["markdown"]
    assert text.startswith("# T & co\n\nlead\n\n## Head\n\none")
    assert "- item" in text and "*Fig 1*" in text and "<table " in text


def test_parsed_value(elements, spark):
    parsed = parse.parsed_documents(elements)
    row = parse.check_version(parsed).select(
        F.expr("parsed_content:document.pages[0].tables[0]::string").alias("t"),
        F.expr("parsed_content:document.pages[0].images[0]::string").alias("i"),
        F.expr("parsed_content:document.elements[4].type::string").alias("e"),
        F.expr("parsed_content:error_status::string").alias("s"),
        F.expr("parsed_content:metadata.format::string").alias("f"),
    ).first()
    assert row["t"].startswith("<table ") and (row["i"], row["e"], row["s"], row["f"]) == ("a.png", "header", None, "html")
    with pytest.raises(Exception, match="expected parser version 9"):
        parse.check_version(parsed, "9").collect()
    assert '"document"' in parsed.select(clean.json_text(parsed, "parsed_content")).first()[0]


def test_quarantine(spark):
    rows = [(1, '{"a":1}', None), (2, '{"a":', None), (3, None, None), (4, '{"a":2}', "timeout")]
    df = spark.createDataFrame(rows, "k int, j string, err string")
    got = {r["k"]: r["status"] for r in parse.split_by_status(df, "j", "err").collect()}
    assert got == {1: "ok", 2: "corrupt", 3: "missing", 4: "error: timeout"}


def test_prompt_with_quote(spark):
    df = spark.createDataFrame([("x'y",)], "t string")
    assert df.select(clean.prompt("don't ", F.col("t"))).first()[0] == "don't x'y"


def test_json_text_of_plain_columns(spark):
    df = spark.createDataFrame([("s", 3)], "a string, b int")
    assert tuple(df.select(clean.json_text(df, "a"), clean.json_text(df, "b")).first()) == ("s", "3")


def test_repeated_content(spark):
    rows = [(f"d{i}", 1, 0, "text", "body", None, "same") for i in range(5)]
    rows += [(f"d{i}", 1, 1, "text", "body", None, f"own {i}") for i in range(5)]
    df = spark.createDataFrame(
        rows, "path string, page int, pos int, type string, region string, level int, content string"
    )
    assert {r["content"] for r in parse.drop_noise(df, 3).collect()} == {f"own {i}" for i in range(5)}


def test_extracted_fields_leave_out_the_absent(spark):
    df = spark.createDataFrame([("by: Ann",), ("",)], "t string")
    got = [r["fields"] for r in metadata.extract_fields(df, "t", {"author": r"by: (\w+)", "date": r"(\d{4})"}).collect()]
    assert got == [{"author": "Ann"}, {}]


def test_files_are_read_whole(spark, sf):
    rows = files.read_files(spark, sf, "*.parquet").collect()
    assert len(rows) == files.list_files(spark, sf, "*.parquet").count()
    assert all(len(r["content"]) == r["length"] for r in rows)


def test_a_quoted_path_is_one_name():
    assert files.read_files_sql("/data/a`b") == "SELECT path, length FROM binaryFile.`/data/a``b`"


def test_model_calls_pass_nulls_through(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "bb")], "k int, t string").coalesce(1)
    got = clean.model_map(df, lambda: lambda texts: [t.upper() for t in texts], "t", "answer", batch_size=1)
    assert [tuple(r)[2] for r in got.orderBy("k").collect()] == ["A", None, "BB"]


@pytest.mark.parametrize("page", ["<p>a<SCRIPT>var x=1;</SCRIPT>", "<p>a<!-- open", "<p>a<Style>p{}"])
def test_invisible_parts_go_in_any_spelling(spark, page):
    df = spark.createDataFrame([(1, page)], "k int, html string")
    assert [r["content"] for r in parse.parse_elements(df, "k", "html").collect()] == ["a"]


def test_deep_headings_stay_headings(spark):
    df = spark.createDataFrame([(1, "<h5>five</h5><h6>six</h6>")], "k int, html string")
    assert clean.markdown(parse.parse_elements(df, "k", "html")).first()["markdown"] == "###### five\n\n###### six"


def test_listing_reads_no_content(spark, sf):
    plan = files.list_files(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_assets_stay_outside_the_input():
    with pytest.raises(ValueError):
        files.check_assets_path("/data/in", "/data/in/images")
    assert files.check_assets_path("/data/in", "/data/input2") == "/data/input2"


def test_overwrite_keeps_old_columns(spark):
    name = f"{scratch_database(spark)}.merge_test"
    tables.overwrite(spark.createDataFrame([(1, "a")], "k int, old string"), name)
    tables.overwrite_merging_schema(spark.createDataFrame([(2, 5)], "k int, new int"), name)
    assert [r.asDict() for r in spark.table(name).collect()] == [{"k": 2, "new": 5, "old": None}]
    tables.append_merging_schema(spark.createDataFrame([(3, 1.5)], "k int, third double"), name, name + "_2")
    assert spark.table(name + "_2").count() == 2
    assert not tables.change_feed_enabled(spark, name)
    with pytest.raises(ValueError, match="no change feed"):
        tables.require_change_feed(spark, name)


def test_stream_ingestion_takes_each_file_once(spark, sf):
    from docsift.streaming import ingest

    inbox, target, progress = (fresh_path(spark, x) for x in ("inbox", "target", "progress"))
    rows = spark.range(10)
    rows.write.parquet(f"{inbox}")
    for expected in (10, 10, 20):
        if expected == 20:
            rows.write.mode("append").parquet(inbox)
        ingest.ingest(ingest.file_stream(spark, inbox, rows.schema, files_per_trigger=2), target, progress)
        assert spark.read.parquet(target).count() == expected


def test_bytes_are_streamed_into_the_parser(spark, tmp_path):
    """Good files become elements, others are set aside; a batch that failed half way counts once."""
    from docsift.operators import parse
    from docsift.streaming import ingest

    inbox, target, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()

    def put(name, content):
        (tmp_path / "in" / name).write_bytes(content)

    def seen(layer):
        rows = spark.read.parquet(f"{target}/{layer}").collect()
        return sorted((r["path"].rsplit("/", 1)[1], r["error_status"] if layer == "quarantine" else r["content"]) for r in rows)

    put("a.html", b"<h1>One</h1><p>first")
    put("b.html", b"\xff\xfe broken")
    put("c.txt", b"not taken")
    put("empty.html", b"")
    real, calls = parse.parse_elements, []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return real(*args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ingest.parse, "parse_elements", fails_once)
        with pytest.raises(Exception, match="lost"):
            ingest.ingest_parsed(spark, inbox, target, progress, "*.html")
        ingest.ingest_parsed(spark, inbox, target, progress, "*.html")
    first = [("a.html", "One"), ("a.html", "first")]
    assert seen("elements") == first and seen("quarantine") == [("b.html", "not UTF-8")]
    put("d.html", "<p>später &amp; mehr".encode())
    ingest.ingest_parsed(spark, inbox, target, progress, "*.html", 1)
    ingest.ingest_parsed(spark, inbox, target, progress, "*.html", 1)
    assert seen("elements") == first + [("d.html", "später & mehr")] and len(seen("quarantine")) == 1
    assert {r["path"].rsplit("/", 1)[1] for r in spark.read.parquet(f"{target}/files").collect()} == {"a.html", "b.html", "d.html"}
    with pytest.raises(ValueError, match="outside"):
        ingest.ingest_parsed(spark, inbox, inbox + "/out", progress)


def test_character_references_and_quotes(spark):
    import duckdb

    from docsift.registry import base

    texts = {
        "caf&eacute; &#8217;x&#x2019;": "café ’x’", "&amp;lt;": "&lt;", "a & b &unknown; &lt": "a & b &unknown; &lt",
        "a&nbsp;b&#160;c": "a b c", "&#128;": "€", "&#0;&#xD800;&#1114112;": "�" * 3, "&NotEqualTilde;": "≂̸",
        "&#x1F600;&&amp;&": "😀&&&", "<b>x</b>&gt;": "x>", "": "", "&" * 500 + "lt;": "&" * 499 + "<",
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in rows.select("t", parse.plain(F.col("t"))).collect()} == texts
    sql = f"SELECT {base._decoded('t')} FROM (SELECT ? AS t)"
    assert {t: duckdb.connect().execute(sql, [t]).fetchone()[0] for t in texts} == texts
    page = spark.createDataFrame([(1, "<p>a</p><div class='ad'>buy</div><DIV  class = \"ad\">now</div><p>b</p>")], "id int, html string")
    got = [(r["region"], r["content"]) for r in parse.parse_elements(page, "id", "html").orderBy("pos").collect()]
    assert got == [("body", "a"), ("ad", "buy"), ("ad", "now"), ("body", "b")]


def test_files_are_read_in_pieces(spark, tmp_path):
    """A large file is dealt to tasks, and its pieces are all of it."""
    folder = tmp_path / "a b%20ü"
    folder.mkdir()
    contents = {"big #1.bin": bytes(range(256)) * 40, "small.bin": b"xyz", "even.bin": b"0" * 2000}
    for name, content in contents.items():
        (folder / name).write_bytes(content)
    pieces = files.read_pieces(files.list_files(spark, str(folder)), 1000).collect()
    assert max(len(r["content"]) for r in pieces) == 1000
    for name, content in contents.items():
        own = sorted((r["start"], r["content"], r["length"]) for r in pieces if r["path"].endswith("/" + name))
        assert b"".join(c for _, c, _ in own) == content and {n for *_, n in own} == {len(content)}
        assert len(own) == -(-len(content) // 1000)


@pytest.mark.parametrize("limit", [64, 1000, 1 << 20])
def test_large_files_are_hashed_by_several_tasks(spark, tmp_path, limit):
    """Digests are those of whole files, whatever one task may take; Spark's reader gives the small ones only."""
    import hashlib

    contents = {"big #1.bin": bytes(range(256)) * 3 + b"x",
                "ü b%20.bin": b"0" * 2000, "small.bin": b"xyz", "even.bin": b"1" * 1000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    found = files.sha256_of(spark, str(tmp_path), "*.bin", limit)
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["sha256"]) for r in found.collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}
    assert found.dtypes == [("path", "string"), ("length", "bigint"), ("sha256", "string")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == (-(-2000 // limit) if limit < 2000 else 0)


def test_file_sizes_are_summed_over_pieces(spark, tmp_path, monkeypatch):
    from docsift.registry import parsing

    (tmp_path / "one.bin").write_bytes(b"a" * 2500)
    cuts, real = [], files.read_pieces
    monkeypatch.setattr(files, "read_pieces", lambda listed: cuts.append(1) or real(listed, 1000))
    assert [(r["length"], r["n_bytes"]) for r in parsing.read_files_sql(spark, str(tmp_path)).collect()] == [(2500, 2500)]
    assert cuts


def test_texts_as_files_share_folders(spark, tmp_path):
    """One file a key, in few folders; texts of a key follow each other, a null one is an empty line."""
    rows = [(i, f"<p>ü{i}\nx") for i in range(2500)] + [(7, "again"), (-3, "below"), (9000, None), (None, "none")]
    table = spark.createDataFrame(rows, "id bigint, html string").repartition(4)
    target = str(tmp_path / "out")
    assert files.write_texts(table, "id", "html", target, "page_id=") == 2503
    found = {r["path"]: bytes(r["content"]) for r in files.read_files(spark, target, "*.txt").collect()}
    assert len(found) == 2503 and len({p.rsplit("/", 1)[0] for p in found}) <= 3
    by_name = {p.rsplit("/", 1)[1]: c.decode() for p, c in found.items()}
    assert by_name["page_id=8.txt"] == "<p>ü8\nx\n" and by_name["page_id=-3.txt"] == "below\n"
    assert by_name["page_id=7.txt"] == "<p>ü7\nx\nagain\n"
    assert by_name["page_id=9000.txt"] == "\n" and by_name["page_id=.txt"] == "none\n"
    assert not list((tmp_path / "out").glob("*/*.unfinished"))


def test_listing_tasks_are_bounded_while_a_stream_runs(spark, tmp_path, monkeypatch):
    from docsift.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<p>x")
    before, seen, real = spark.conf.get(ingest.LISTING), [], parse.parse_elements

    def looked(*args):
        seen.append(spark.conf.get(ingest.LISTING))
        return real(*args)

    monkeypatch.setattr(ingest.parse, "parse_elements", looked)
    ingest.ingest_parsed(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"), "*.html")
    assert seen == [str(ingest.LISTING_TASKS)] and spark.conf.get(ingest.LISTING) == before
