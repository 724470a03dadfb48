"""Raw pages to elements to chunks, one table per layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docsift.operators import chunk, clean, parse
from docsift.sources import tables


def silver(pages: DataFrame, path: str, html: str, page: str | None = None) -> DataFrame:
    """Typed elements without page furniture."""
    return parse.drop_noise(parse.parse_elements(pages, path, html, page))


def gold(elements: DataFrame, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Chunks with stable ids."""
    text = clean.plain_text(elements)
    return chunk.chunk_ids(chunk.fixed_chars(text, ["path"], "plain_text", size, overlap), ["path", "pos"])


def build_layers(
    pages: DataFrame, database: str, path: str, html: str, page: str | None = None, name: str = "documents"
) -> dict[str, str]:
    """Write the three tables of the source `name`; each layer reads the one before from
    storage, so nothing is parsed twice."""
    spark = pages.sparkSession
    names = {layer: f"{database}.{layer}_{name}" for layer in ("bronze", "silver", "gold")}
    tables.overwrite(pages, names["bronze"])
    tables.overwrite(silver(spark.table(names["bronze"]), path, html, page), names["silver"])
    tables.overwrite(gold(spark.table(names["silver"])), names["gold"])
    return names
