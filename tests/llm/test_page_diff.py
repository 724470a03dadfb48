import random

import pytest
from pyspark.sql import functions as F

from docsift.llm import page_diff, store
from docsift.llm.html_lines import lines

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><SCRIPT>var a="</p>";</SCRIPT></head><body>
<header>Site</header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy</div><article class="comment-ready post"><h1>Big &amp; small&#33;</h1><p>One <b>t</b>wo&nbsp; three<p>Caf&eacute;<br>au lait
<aside>See also</aside><form><input><label>Name</label></form><div id="share-buttons">Share</div><!-- <p>no</p> -->
<ul><li>x<li>y</ul><table><tr><td>1<td>2</table><section class="comments"><p>First!</p></section></article>
<div role="complementary">Side</div><footer>&copy; me</footer></body></html>"""


def text_of(page):
    found = lines(page)
    return " ".join(t for (t, _), s in zip(found, page_diff.settled(found), strict=True) if s is not False)


@pytest.mark.parametrize(
    "page,text",
    [
        (ARTICLE.replace("comment-ready ", ""), "Big & small! One two three Café au lait x y 1 2"),
        (None, ""),
        ("", ""),
        ("plain &lt; text &am", "plain < text &am"),
        ("<p>a</p>b<div>c</div>", "a b c"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<p>a<!-- unclosed", "a"),
        ("<p>a<script>unclosed", "a"),
        ('<p>a < b and <a href="x>y">link</a>', "a < b and link"),
        ("<div class='sidebar'><div>x</div></div><p>y", "y"),
        ("<p hidden>x<p style='display: none'>x<p aria-hidden=true>x<p>y", "y"),
        ("<article><p>a</article><article><p>b</article>", "a b"),
        ("<p>" + "w " * 100_000 + "</p>", " ".join(["w"] * 100_000)),
    ],
)
def test_structure(page, text):
    assert text_of(page) == text


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(16))] for _ in range(2))
        found = page_diff.common(a, b)
        rest = iter(b)
        assert found == sorted(set(found)) and all(a[i] in rest for i in found)
        assert len(found) == longest(a, b)
    assert page_diff.common(list(range(5000)), list(range(1, 5001))) == list(range(1, 5000))


def page(*paragraphs):
    return "<html><body>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</body></html>"


def extracted(spark, rows):
    store.settle(spark)
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table = table.withColumns({"host": F.lit(1), "path": F.lit(2), "mark": F.lit(3), "drop": F.lit(4), "text": F.lit("x")})
    return {(r["page_id"], r["url"]): r["text"] for r in page_diff.extract(spark, table).collect()}


def test_lines_shared_with_the_nearest_page_go(spark):
    got = extracted(
        spark,
        [
            (1, "http://a.example/news/1", page("Menu", "first story", "Imprint")),
            (2, "https://A.example/news/2?x=1", page("Menu", "second story", "Imprint")),
            (3, "http://a.example/shop/1", page("Cart", "a thing", "Imprint")),
            (4, "http://b.example/news/1", page("Menu", "other host", "Imprint")),
            (5, "http://c.example/1", page("same", "lines")),
            (6, "http://c.example/2", page("same", "lines")),
            (7, "http://d.example/1", "<nav>N</nav><article><p>shared</p></article>"),
            (8, "http://d.example/2", "<nav>N</nav><article><p>shared</p></article>"),
            (9, None, page("Menu", "no address")),
            (10, "http://e.example/", None),
        ],
    )
    assert got == {
        (1, "http://a.example/news/1"): "first story",
        (2, "https://A.example/news/2?x=1"): "second story",
        (3, "http://a.example/shop/1"): "Cart a thing",
        (4, "http://b.example/news/1"): "Menu other host Imprint",
        (5, "http://c.example/1"): "same lines",
        (6, "http://c.example/2"): "same lines",
        (7, "http://d.example/1"): "shared",
        (8, "http://d.example/2"): "shared",
        (9, None): "Menu no address",
        (10, "http://e.example/"): "",
    }


def test_repeated_rows_and_empty_table(spark):
    store.settle(spark)
    rows = [(1, "http://a.example/1", page("a", "b"))] * 3 + [(None, "http://a.example/2", page("a", "c"))]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r["text"] for r in page_diff.extract(spark, table).collect()) == ["b", "b", "b", "c"]
    assert page_diff.extract(spark, table.where("false")).count() == 0


def test_differencing_decides_where_an_article_is_a_teaser(spark):
    """A small article that neighbours share goes with their menu, and the body, declared or not, stays."""
    body = "the story of page {} goes on and on, line after line, to its end"
    frame = "<p>Menu without a tag</p>{}<article><p>Read also this</p></article><p>Imprint</p>"
    rows = [(i, f"http://a.example/{i}", frame.format(f"<div>{body.format(i)}</div>")) for i in (1, 2, 3)]
    rows += [(i, f"http://b.example/{i}", frame.format(f"<main><div>{body.format(i)}</div></main>")) for i in (4, 5)]
    # Own text beside an article that holds most of it does not count; a copied article stays whole.
    rows += [(i, f"http://c.example/{i}", f"<p>No {i}</p><article><p>{body.format(0)}</p></article>") for i in (6, 7)]
    assert {k[0]: v for k, v in extracted(spark, rows).items()} == {
        **{i: body.format(i) for i in (1, 2, 3, 4, 5)}, 6: body.format(0), 7: body.format(0),
    }
