"""Registration of queries with their SQL twins, and shared SQL fragments."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_parts(sql)
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def toks(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda t: t <> '')"


def trimmed(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def nonblank(pieces: str) -> str:
    return f"list_filter(list_transform({pieces}, lambda p: {trimmed('p')}), lambda p: p <> '')"


def sentences(text: str) -> str:
    cut = f"regexp_replace({text}, '([.!?])\\s+', '\\1' || chr(1), 'g')"
    return nonblank(f"string_split(regexp_replace({cut}, '\\n+', chr(1), 'g'), chr(1))")


def bucket(token: str, dim: int = 64) -> str:
    return f"(CAST('0x' || substr(md5({token}), 1, 8) AS BIGINT) % {dim})"


def sign(token: str) -> str:
    return f"(1 - 2 * (CAST('0x' || substr(md5({token}), 9, 1) AS INTEGER) % 2))"


def _named() -> str:
    """The public table of named character references, as a JSON literal of SQL."""
    table = {n[:-1]: " " if c == "\xa0" else c for n, c in html5.items() if n.endswith(";")}
    return "'" + json.dumps(table).replace("'", "''") + "'"


def _decoded(text: str) -> str:
    """Without tags, references decoded: windows-1252 for 128 to 159, no-break spaces as spaces, U+FFFD for
    numbers that are no characters."""
    bare = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    ref = "regexp_extract(p, '^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});', 1)"
    number = (
        f"CASE WHEN lower({ref}[2:2]) = 'x' THEN CAST('0x' || {ref}[3:] AS BIGINT) ELSE CAST({ref}[2:] AS BIGINT) END"
    )
    latin = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160))
    char = f"""list_transform([{number}], lambda c: CASE WHEN c < 1 OR c BETWEEN 55296 AND 57343 OR c > 1114111 THEN chr(65533)
        WHEN c = 160 THEN ' ' WHEN c BETWEEN 128 AND 159 THEN '{latin}'[c - 127 : c - 127] ELSE chr(CAST(c AS INTEGER)) END)[1]"""
    found = f"CASE WHEN {ref}[1:1] = '#' THEN {char} ELSE json_extract_string({_named()}, '$.\"' || {ref} || '\"') END"
    piece = f"CASE WHEN i = 1 THEN p WHEN {ref} = '' THEN '&' || p ELSE coalesce({found} || substr(p, length({ref}) + 2), '&' || p) END"
    return trimmed(f"array_to_string(list_transform(string_split({bare}, '&'), lambda p, i: {piece}), '')")


_BLOCKS = "h1|h2|h3|h4|h5|h6|p|li|title|figure|figcaption|article|section|ul|ol|div|head|body|html"

# Named common table expressions; a query names those it needs with {{name}} in
# its FROM clauses and gets them, with what they need, in a WITH clause.
STORED: set[str] = set()  # those that DuckDB should compute once
PARTS: dict[str, str] = {
    "marked": """
        SELECT page_id AS path, regexp_replace(regexp_replace(
          regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            regexp_replace(html, '(?is)<script.*?(?:</script>|\\z)|<style.*?(?:</style>|\\z)|<!--.*?(?:-->|\\z)', '', 'g'),
            '(?i)<(/?)nav\\b', '<\\1nav', 'g'), '(?i)<(/?)footer\\b', '<\\1footer', 'g'),
            '(?i)<(/?)table\\b', '<\\1table', 'g'), '(?i)<(/?)div\\b', '<\\1div', 'g'),
          '<(nav|footer|table)\\b', chr(3) || '\\1' || chr(2) || '\\0', 'g'),
          '<div\\s+class\\s*=\\s*(?:"ad"|''ad'')', chr(3) || 'ad' || chr(2) || '\\0', 'g') AS m
        FROM pages""",
    "sections": """
        SELECT path, s, si, split_part(s, chr(2), 1) AS name,
          substr(s, length(split_part(s, chr(2), 1)) + 2) AS inside,
          CASE split_part(s, chr(2), 1) WHEN 'ad' THEN '</div>' ELSE '</' || split_part(s, chr(2), 1) || '>' END AS close
        FROM (SELECT path, unnest(string_split(m, chr(3))) AS s, unnest(range(len(string_split(m, chr(3))))) AS si
              FROM {{marked}})""",
    "regions": """
        SELECT path, 0 AS si, 0 AS half, 'body' AS region, s AS markup FROM {{sections}} WHERE si = 0
        UNION ALL
        SELECT path, si, 0, name, split_part(inside, close, 1) || close FROM {{sections}} WHERE si > 0
        UNION ALL
        SELECT path, si, 1, 'body', substr(inside, length(split_part(inside, close, 1)) + length(close) + 1)
        FROM {{sections}} WHERE si > 0""",
    "cut": f"""
        SELECT path, si, half, region, CASE WHEN region = 'table' THEN [markup] ELSE string_split(
          regexp_replace(regexp_replace(markup, '(?i)<(img\\s[^>]*)>', chr(1) || '\\1' || chr(2) || chr(1) || 'p' || chr(2), 'g'),
            '(?i)<({_BLOCKS})(?:\\s[^>]*)?>', chr(1) || '\\1' || chr(2), 'g'), chr(1)) END AS raws
        FROM {{{{regions}}}}""",
    "pieces": """
        SELECT path, si, half, region, unnest(raws) AS raw, unnest(range(len(raws))) AS pi FROM {{cut}}""",
    "tagged": """
        SELECT path, region, raw, head, lower(regexp_extract(head, '^(\\w+)', 1)) AS tag, pos, body FROM (
          SELECT path, region, raw,
            row_number() OVER (PARTITION BY path ORDER BY si, half, pi) - 1 AS pos,
            CASE WHEN contains(raw, chr(2)) THEN split_part(raw, chr(2), 1) END AS head,
            CASE WHEN contains(raw, chr(2)) THEN split_part(raw, chr(2), 2) ELSE raw END AS body
          FROM {{pieces}})""",
    "elements": f"""
        SELECT * FROM (
          SELECT path, 1 AS page, CAST(pos AS INTEGER) AS pos,
            CASE WHEN region = 'table' THEN 'table' WHEN tag = 'title' THEN 'title'
                 WHEN regexp_matches(tag, '^h[1-6]$') THEN 'header' WHEN tag = 'li' THEN 'list_item'
                 WHEN tag = 'img' THEN 'image' WHEN tag = 'figcaption' THEN 'caption'
                 ELSE 'text' END AS type,
            region,
            CASE WHEN tag = 'title' THEN 1
                 WHEN regexp_matches(tag, '^h[1-6]$') THEN CAST(substr(tag, 2, 1) AS INTEGER) + 1 END AS level,
            CASE WHEN region = 'table' THEN raw
                 WHEN tag = 'img' THEN regexp_extract(head, 'src="([^"]*)"', 1)
                 ELSE {_decoded('body')} END AS content
          FROM {{{{tagged}}}})
        WHERE content <> ''""",
    "clean_elements": """
        SELECT * FROM {{elements}}
        WHERE region NOT IN ('nav', 'footer', 'ad') AND NOT regexp_full_match(content, '\\d+')""",
    "page_markdown": """
        SELECT path, string_agg(
          CASE WHEN type IN ('title', 'header') THEN repeat('#', CAST(least(coalesce(level, 2), 6) AS INTEGER)) || ' ' || content
               WHEN type = 'list_item' THEN '- ' || content
               WHEN type = 'caption' THEN '*' || content || '*'
               WHEN type = 'image' THEN '![](' || content || ')'
               ELSE content END, chr(10) || chr(10) ORDER BY pos) AS markdown
        FROM {{clean_elements}} GROUP BY path""",
    "tok": f"SELECT doc_id, unnest({toks('text')}) AS term FROM documents",
    "lens": f"SELECT doc_id, len({toks('text')}) AS doc_len FROM documents",
    "post": """
        SELECT t.doc_id, t.term, count(*) AS tf, any_value(l.doc_len) AS doc_len
        FROM {{tok}} t JOIN {{lens}} l USING (doc_id) GROUP BY t.doc_id, t.term""",
    "freq": "SELECT term, count(*) AS df FROM {{post}} GROUP BY term",
    "corpus": "SELECT count(*) AS n, sum(doc_len) / count(*)::DOUBLE AS avg_len FROM {{lens}}",
    "qtok": f"SELECT item_id AS query_id, unnest({toks('text')}) AS term FROM benchmark",
    "qterm": "SELECT DISTINCT query_id, term FROM {{qtok}}",
    "dvec": f"SELECT doc_id, {bucket('term')} AS b, sum({sign('term')})::DOUBLE AS c FROM {{{{tok}}}} GROUP BY 1, 2",
    "qvec": f"SELECT query_id, {bucket('term')} AS b, sum({sign('term')})::DOUBLE AS c FROM {{{{qtok}}}} GROUP BY 1, 2",
    "dnorm": "SELECT doc_id, sqrt(sum(c * c)) AS len FROM {{dvec}} GROUP BY 1 HAVING sum(c * c) > 0",
    "qnorm": "SELECT query_id, sqrt(sum(c * c)) AS len FROM {{qvec}} GROUP BY 1 HAVING sum(c * c) > 0",
    "dots": """
        SELECT query_id, doc_id, sum(q.c * d.c) AS dot
        FROM {{qvec}} q JOIN {{dvec}} d USING (b) GROUP BY 1, 2""",
    "cosines": """
        SELECT q.query_id, d.doc_id, round(coalesce(x.dot, 0) / (q.len * d.len), 6) AS score
        FROM {{qnorm}} q CROSS JOIN {{dnorm}} d LEFT JOIN {{dots}} x USING (query_id, doc_id)""",
    "bm25": """
        SELECT query_id, doc_id, round(sum(
            ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
            / (tf + 1.2 * (0.25 + 0.75 * doc_len / avg_len))), 6) AS score
        FROM {{qterm}} JOIN {{post}} USING (term) JOIN {{freq}} USING (term), {{corpus}}
        GROUP BY query_id, doc_id""",
}
for _name, _source in (("sim", "cosines"), ("key", "bm25")):
    PARTS[f"{_name}_all"] = f"""
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
        FROM {{{{{_source}}}}}"""
    PARTS[f"{_name}50"] = f"SELECT * FROM {{{{{_name}_all}}}} WHERE rank <= 50"
PARTS["fused"] = """
    SELECT query_id, doc_id,
      round(coalesce(1.0 / (60 + a.rank), 0) + coalesce(1.0 / (60 + b.rank), 0), 6) AS score
    FROM {{sim50}} a FULL JOIN {{key50}} b USING (query_id, doc_id)"""
PARTS["fused_all"] = """
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM {{fused}}"""


def coverage(asked: str, held: str) -> str:
    """SQL of the coverage score of two texts."""

    def pairs(t: str) -> str:
        return f"list_distinct(list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1]))"

    def share(q: str, d: str) -> str:
        return f"CASE WHEN len({q}) = 0 THEN 0.0 ELSE len(list_intersect({q}, {d})) / len({q})::DOUBLE END"

    return f"round(({share(f'list_distinct({asked})', held)} + {share(pairs(asked), pairs(held))}) / 2, 6)"


def with_parts(sql: str, parts: dict[str, str] | None = None) -> str:
    """Expand {{name}} references into one WITH clause."""
    known = {**PARTS, **(parts or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\{\{(\w+)\}\}", text):
            if name not in order:
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    body = sql
    if order:
        ctes = ",\n".join(f"{name} AS{' MATERIALIZED' * (name in STORED)} (\n{known[name].strip()}\n)" for name in order)
        body = f"WITH {ctes}\n{sql.strip()}"
    return re.sub(r"\{\{(\w+)\}\}", r"\1", body)
