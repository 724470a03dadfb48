"""HTML files to typed elements, row by row and without a shuffle.

The markup is cut with plain string functions:

1. scripts, styles and comments go;
2. `<nav>`, `<footer>`, `<div class="ad">` (either quotes) and `<table>` open a region that runs
   to its closing tag, or to the next region; tables stay whole, the other three
   are page furniture;
3. outside tables every opening block tag starts a new element (closing tags
   are often missing, so they are not relied on);
4. remaining tags go, character references are decoded, blank pieces are dropped.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.functions.let import let
from docsift.functions.tokens import BLANKS
from docsift.session import counted, small_side

SCHEMA_VERSION = "2.0"

# Control characters that mark cuts; they do not occur in text.
CUT, HEAD_END, REGION_OPEN = "\x01", "\x02", "\x03"

INVISIBLE = r"(?is)<script.*?(?:</script>|\z)|<style.*?(?:</style>|\z)|<!--.*?(?:-->|\z)"
REGION_TAGS = ("nav", "footer", "table", "div")
AD = r"""<div\s+class\s*=\s*(?:"ad"|'ad')"""
BLOCK_TAGS = "h1|h2|h3|h4|h5|h6|p|li|title|figure|figcaption|article|section|ul|ol|div|head|body|html"

REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

TYPE_OF_TAG = (
    ("title", "title"),
    ("h[1-6]", "header"),
    ("li", "list_item"),
    ("img", "image"),
    ("figcaption", "caption"),
)
NOISE_REGIONS = ("nav", "footer", "ad")


def _marked(html: Column) -> Column:
    """Visible markup, with the start of each region marked and named."""
    text = F.regexp_replace(html, INVISIBLE, "")
    lowered = text
    for tag in REGION_TAGS:
        lowered = F.regexp_replace(lowered, rf"(?i)<(/?){tag}\b", f"<$1{tag}")
    text = F.when(text.rlike("</?[A-Z]"), lowered).otherwise(text)
    text = F.regexp_replace(text, r"<(nav|footer|table)\b", REGION_OPEN + "$1" + HEAD_END + "$0")
    return F.regexp_replace(text, AD, REGION_OPEN + "ad" + HEAD_END + "$0")


def _regions(marked: Column) -> Column:
    """Array of (region, markup); region 'body' outside the marked ones."""

    def before(text: Column, mark: Column) -> Column:
        return F.call_function("substring_index", text, mark, F.lit(1))

    def named(section: Column, name: Column) -> Column:
        inside = F.substr(section, F.length(name) + 2, F.length(section))
        close = F.when(name == "ad", F.lit("</div>")).otherwise(F.concat(F.lit("</"), name, F.lit(">")))
        return let(
            F.struct(inside.alias("inside"), close.alias("close")),
            lambda s: let(before(s["inside"], s["close"]), lambda head: parts(name, s["inside"], s["close"], head)),
        )

    def parts(name: Column, inside: Column, close: Column, head: Column) -> Column:
        tail = F.substr(inside, F.length(head) + F.length(close) + 1, F.length(inside))
        return F.array(
            F.struct(name.alias("region"), F.concat(head, close).alias("markup")),
            F.struct(F.lit("body").alias("region"), tail.alias("markup")),
        )

    def cut(section: Column, index: Column) -> Column:
        whole = F.array(F.struct(F.lit("body").alias("region"), section.alias("markup")))
        return F.when(index == 0, whole).otherwise(
            let(before(section, F.lit(HEAD_END)), lambda name: named(section, name))
        )

    return F.flatten(F.transform(F.split(marked, REGION_OPEN), cut))


def _cut_blocks(markup: Column) -> Column:
    """Markup with a mark before each block; what follows an image is a block too."""
    images = F.regexp_replace(markup, r"(?i)<(img\s[^>]*)>", f"{CUT}$1{HEAD_END}{CUT}p{HEAD_END}")
    return F.regexp_replace(images, rf"(?i)<({BLOCK_TAGS})(?:\s[^>]*)?>", f"{CUT}$1{HEAD_END}")


def _reference_table() -> dict[str, str]:
    """Characters by name, as HTML has them, the commonest first, and by number (`#128` on) where HTML reads
    the number as one of windows-1252. No-break spaces become spaces."""
    named = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
    numbered = {f"#{i}": bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)}
    first = {n: named[n] for n in ("amp", "lt", "gt", "quot", "apos", "copy", "middot")}
    return {"nbsp": " ", "#160": " "} | first | {n: c for n, c in named.items() if n not in ("nbsp", "NonBreakingSpace")} | {
        "NonBreakingSpace": " "
    } | numbered


def decode_references(text: Column) -> Column:
    """Character references by name or number, decoded once from left to right; unknown names, and those without
    semicolon, stay. Numbers that are no characters become U+FFFD."""
    table = F.from_json(F.lit(json.dumps(_reference_table())), "map<string,string>")

    def numbered(number: Column) -> Column:
        bad = (number < 1) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        special = F.try_element_at(table, F.concat(F.lit("#"), number.cast("string")))
        return F.when(bad, "\ufffd").when(number.between(128, 160), special).otherwise(char)

    def char_of(ref: Column) -> Column:
        digits = F.regexp_extract(ref, "[0-9A-Fa-f]+$", 0)
        return (
            F.when(ref.rlike("^#[xX]"), numbered(F.conv(digits, 16, 10).cast("bigint")))
            .when(F.startswith(ref, F.lit("#")), numbered(F.conv(digits, 10, 10).cast("bigint")))
            .otherwise(F.try_element_at(table, ref))
        )

    def piece(part: Column, index: Column) -> Column:
        decoded = let(
            F.regexp_extract(part, REFERENCE, 1),
            lambda ref: F.concat(char_of(ref), F.substr(part, F.length(ref) + 2, F.length(part))),
        )
        return F.when(index == 0, part).when(
            part.rlike(REFERENCE), F.coalesce(decoded, F.concat(F.lit("&"), part))
        ).otherwise(F.concat(F.lit("&"), part))

    whole = F.array_join(F.transform(F.split(text, "&"), piece), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def plain(markup: Column) -> Column:
    """Markup without tags, character references decoded, ends trimmed."""
    return F.trim(decode_references(F.regexp_replace(markup, r"<[^>]*>", "")), F.lit(BLANKS))


def parse_elements(pages: DataFrame, path: str, html: str, page: str | None = None) -> DataFrame:
    """`path, page, pos, type, region, level, content`, one row per element.

    `pos` counts the pieces of a page, so it keeps the reading order; `level` is
    the heading depth (title 1, h1 2, ...). Tables keep their markup.
    """
    number = F.col(page).cast("int") if page else F.lit(1)

    def pieces(region: Column) -> Column:
        markup = region["markup"]
        whole = F.array(F.struct(region["region"].alias("region"), markup.alias("raw")))
        parts = F.transform(
            F.split(_cut_blocks(markup), CUT), lambda raw: F.struct(region["region"].alias("region"), raw.alias("raw"))
        )
        return F.when(region["region"] == "table", whole).otherwise(parts)

    rows = pages.select(
        F.col(path).alias("path"),
        number.alias("page"),
        F.posexplode_outer(F.flatten(F.transform(_regions(_marked(F.col(html))), pieces))).alias("pos", "piece"),
    )
    raw = F.col("piece.raw")
    has_head = F.contains(raw, F.lit(HEAD_END))
    head = F.when(has_head, F.substring_index(raw, HEAD_END, 1))
    tag = F.lower(F.regexp_extract(head, r"^(\w+)", 1))
    body = F.substring_index(raw, HEAD_END, -1)
    kind = F.when(F.col("piece.region") == "table", F.lit("table"))
    for pattern, name in TYPE_OF_TAG:
        kind = kind.when(F.col("tag").rlike(f"^(?:{pattern})$"), F.lit(name))
    level = F.when(F.col("tag") == "title", 1).when(
        F.col("tag").rlike(r"^h[1-6]$"), F.substring("tag", 2, 1).cast("int") + 1
    )
    content = (
        F.when(F.col("piece.region") == "table", raw)
        .when(F.col("tag") == "img", F.regexp_extract("head", r'src="([^"]*)"', 1))
        .otherwise(plain(F.col("body")))
    )
    return (
        rows.filter(F.col("piece").isNotNull())
        .withColumns({"head": head, "tag": tag, "body": body})
        .select(
            "path",
            "page",
            "pos",
            kind.otherwise(F.lit("text")).alias("type"),
            F.col("piece.region").alias("region"),
            level.alias("level"),
            # A filter on the expression itself would compute it a second time.
            F.explode_outer(F.array(F.nullif(content, F.lit("")))).alias("content"),
        )
        .filter(F.col("content").isNotNull())
    )


def decoded(files: DataFrame, path: str, content: str) -> DataFrame:
    """`path, html, size, error_status` of file rows: the text of their bytes, or null and why."""
    text = F.try_validate_utf8(F.col(content).cast("string"))
    status = F.when(F.col(content).isNull(), "no content").when(text.isNull(), "not UTF-8")
    return files.select(
        F.col(path).alias("path"),
        text.alias("html"),
        F.octet_length(content).cast("bigint").alias("size"),
        status.alias("error_status"),
    )


def with_user_parser(files: DataFrame, parse: Callable, schema) -> DataFrame:
    """Run a caller's `Iterator[DataFrame] -> Iterator[DataFrame]` decoder (PDF, DOCX,
    OCR ...) over the file rows; it loads once per task."""
    return files.mapInPandas(parse, schema)


def keep_types(elements: DataFrame, types: list[str]) -> DataFrame:
    """Elements of the given types; `*` keeps all."""
    return elements if "*" in types else elements.filter(F.col("type").isin(list(types)))


def attach_captions(elements: DataFrame, caption_type: str, target_type: str) -> DataFrame:
    """Each target with the caption right before it, else the one right after it."""
    order = Window.partitionBy("path", "page").orderBy("pos")

    def neighbour(step: Callable) -> Column:
        return F.when(step(F.col("type")).over(order) == caption_type, step(F.col("content")).over(order))

    return (
        elements.withColumn("caption", F.coalesce(neighbour(F.lag), neighbour(F.lead)))
        .filter(F.col("type") == target_type)
        .select("path", "page", "pos", "caption", "content")
    )


def drop_noise(elements: DataFrame, repeated_in: int | None = None) -> DataFrame:
    """Without navigation, footers, ads and page numbers; with `repeated_in`, also
    without any content found in that many documents or more."""
    body = elements.filter(~F.col("region").isin(*NOISE_REGIONS)).filter(~F.col("content").rlike(r"^\d+$"))
    if repeated_in is None:
        return body
    # Digests move in place of the lines, distinct per document before counting: a
    # line held by a third of all documents leaves each task as one partial count.
    marked = body.withColumn("_digest", F.md5("content"))
    often = (
        marked.select("path", "_digest")
        .distinct()
        .groupBy("_digest")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= repeated_in)
        .select("_digest")
    )
    repeated, n = counted(elements.sparkSession, often, "repeated-lines")
    return marked.join(small_side(repeated, n), "_digest", "left_anti").select(*elements.columns)


def describe_elements(elements: DataFrame, types: list[str], describe: Callable[[Column, Column], Column]) -> DataFrame:
    """Fill `description` for the chosen types from a caller's expression over (type, content)."""
    wanted = F.lit(True) if "*" in types else F.col("type").isin(list(types))
    return elements.withColumn("description", F.when(wanted, describe(F.col("type"), F.col("content"))))


def element_spans(elements: DataFrame, joint: str = "\n") -> DataFrame:
    """1-based `[start, end]` of each element in the joined text of its page.

    HTML has no boxes, so `bbox` is null and the span takes its place.
    """
    before = Window.partitionBy("path", "page").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("content") + len(joint)).over(before), F.lit(0)) + 1
    return (
        elements.withColumn("start", start)
        .withColumn("end", F.col("start") + F.length("content") - 1)
        .withColumn("bbox", F.lit(None).cast("array<int>"))
    )


def references(pages: DataFrame, path: str, html: str, page: str | None = None) -> DataFrame:
    """`path, page, pos, ref` of the images and links a page points to."""
    number = F.col(page).cast("int") if page else F.lit(1)
    found = F.regexp_extract_all(F.col(html), F.lit(r'(?:src|href)="([^"]*)"'), F.lit(1))
    return (
        pages.select(F.col(path).alias("path"), number.alias("page"), F.posexplode_outer(found).alias("pos", "ref"))
        .filter(F.col("pos").isNotNull())
    )


def parsed_documents(elements: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One VARIANT per path: `document{pages, elements, metadata}`, status fields,
    version. With `files(path, size, error_status)` every file has one, with its size and
    status, whether it has elements or not. Pages are put together first, each on its own; a document is one value,
    so all its pages meet in one row."""
    per_page = elements.groupBy("path", "page").agg(
        F.sort_array(F.collect_list(F.struct("pos", "type", "region", "content"))).alias("items")
    )

    def of_type(kind: str) -> Column:
        return F.transform(F.filter("items", lambda e: e["type"] == kind), lambda e: e["content"])

    page = F.struct(
        F.col("page").alias("page_number"),
        F.array_join(F.transform("items", lambda e: e["content"]), "\n").alias("text"),
        of_type("table").alias("tables"),
        of_type("image").alias("images"),
    )
    item = F.transform(
        "items",
        lambda e: F.struct(
            e["type"].alias("type"), F.col("page").alias("page_number"), e["content"].alias("content")
        ),
    )
    per_path = per_page.groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("page", page.alias("whole"), item.alias("items")))).alias("pages")
    )
    pages = F.transform("pages", lambda p: p["whole"])
    listed = F.transform(
        F.flatten(F.transform("pages", lambda p: p["items"])),
        lambda e, i: F.struct(
            i.alias("id"), e["type"].alias("type"), e["page_number"].alias("page_number"), e["content"].alias("content")
        ),
    )
    none = F.lit(None).cast("string")
    if files is None:
        per_path = per_path.withColumns({"size": F.lit(None).cast("bigint"), "error_status": none})
    else:
        per_path = files.select("path", "size", "error_status").join(per_path, "path", "left")
    name = F.regexp_extract("path", r"([^/?#]*)(?:[?#].*)?$", 1)
    metadata = F.struct(name.alias("file_name"), F.lit("html").alias("format"), F.col("size"))
    whole = F.struct(
        F.struct(pages.alias("pages"), listed.alias("elements"), metadata.alias("metadata")).alias("document"),
        F.col("error_status"),
        none.alias("corrupted_data"),
        metadata.alias("metadata"),
        F.lit(SCHEMA_VERSION).alias("version"),
    )
    return per_path.select("path", F.to_variant_object(whole).alias("parsed_content"))


def check_version(parsed: DataFrame, version: str = SCHEMA_VERSION) -> DataFrame:
    """Pass rows of the expected parser version; any other fails the job."""
    found = F.expr("variant_get(parsed_content, '$.version', 'string')")
    message = F.concat(F.lit(f"expected parser version {version}, found "), F.coalesce(found, F.lit("none")))
    return parsed.filter(
        F.when(F.equal_null(found, F.lit(version)), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )


def split_by_status(rows: DataFrame, json_col: str, status_col: str | None = None) -> DataFrame:
    """Add `parsed` and `status`: 'ok', or why the document goes to quarantine."""
    parsed = F.try_parse_json(F.col(json_col))
    reported = F.col(status_col) if status_col else F.lit(None).cast("string")
    status = (
        F.when(F.col(json_col).isNull(), "missing")
        .when(parsed.isNull(), "corrupt")
        .when(reported.isNotNull(), F.concat(F.lit("error: "), reported))
        .otherwise("ok")
    )
    return rows.withColumns({"parsed": parsed, "status": status})


def parse_report(elements: DataFrame) -> DataFrame:
    """Elements and characters per path, page and type."""
    return elements.groupBy("path", "page", "type").agg(
        F.count("*").alias("n_elements"), F.sum(F.length("content")).cast("bigint").alias("n_chars")
    )
