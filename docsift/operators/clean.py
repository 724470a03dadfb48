"""Parsed elements to clean text, prompts, and per-row model calls."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_MARK = "\n== page ==\n"

MARKDOWN_PROMPT = (
    "Rewrite the parsed document below, given as JSON, as Markdown. Keep its headings, tables and captions, "
    "put a line with == page == between two pages, and answer with the Markdown alone.\n\n"
)


def _joined(rows: DataFrame, text: str, line_break: str) -> DataFrame:
    """Lines to page text, page texts to document text, in reading order.

    The pages of a path are put together in as many tasks as they lie in; a path's text
    is one value, so its page texts meet in one row.
    """

    def texts(of: str, by: str) -> Column:
        lines = F.sort_array(F.collect_list(F.struct(by, F.col(of).alias("line"))))
        return F.transform(lines, lambda row: row["line"])

    per_page = rows.groupBy("path", "page").agg(F.array_join(texts(text, "pos"), line_break).alias(text))
    return per_page.groupBy("path").agg(F.array_join(texts(text, "page"), PAGE_MARK).alias(text))


def plain_text(elements: DataFrame, text_col: str = "content") -> DataFrame:
    """`path, plain_text`: all text of each page, `== page ==` between pages.

    Text that already holds the mark has it softened to `= = page = =`.
    """
    safe = F.replace(F.col(text_col), F.lit("== page =="), F.lit("= = page = ="))
    return _joined(elements.withColumn("plain_text", safe), "plain_text", "\n")


def markdown_line(kind: Column, level: Column, content: Column) -> Column:
    """Markdown of one element: headings, bullets and captions marked, tables kept."""
    return (
        F.when(kind.isin("title", "header"), F.concat(F.repeat(F.lit("#"), F.least(F.coalesce(level, F.lit(2)), F.lit(6))), F.lit(" "), content))
        .when(kind == "list_item", F.concat(F.lit("- "), content))
        .when(kind == "caption", F.concat(F.lit("*"), content, F.lit("*")))
        .when(kind == "image", F.concat(F.lit("![]("), content, F.lit(")")))
        .otherwise(content)
    )


def markdown(elements: DataFrame) -> DataFrame:
    """`path, markdown`, elements set apart by blank lines."""
    line = markdown_line(F.col("type"), F.col("level"), F.col("content"))
    return _joined(elements.withColumn("markdown", line), "markdown", "\n\n")


def json_text(df: DataFrame, column: str) -> Column:
    """JSON string of a VARIANT, struct, map or array column; other types as text."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.VariantType, T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(F.col(column))
    return F.col(column).cast("string")


def prompt(prefix: str, body: Column) -> Column:
    """Instruction and data as one string; the prefix is a literal, quotes and all."""
    return F.concat(F.lit(prefix), body)


def model_map(
    df: DataFrame,
    load: Callable[[], Callable[[list[str]], list[str]]],
    in_col: str,
    out_col: str,
    batch_size: int = 64,
) -> DataFrame:
    """Call a text model per row, in batches; `load()` runs once per task. A null has a
    null answer and is not sent."""

    @F.pandas_udf(T.StringType())
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            known = batch.dropna()
            answers: list[str] = []
            for start in range(0, len(known), batch_size):
                answers.extend(model(known.iloc[start : start + batch_size].tolist()))
            yield pd.Series(answers, index=known.index, dtype=object).reindex(batch.index)

    return df.withColumn(out_col, call(F.col(in_col)))
