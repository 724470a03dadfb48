"""Document metadata and rule-based fields, for filtering before search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def document_metadata(files: DataFrame, key: str, path: str, content: str, fmt: str) -> DataFrame:
    """Key, file name, size in bytes and format."""
    name = F.regexp_extract(F.col(path), r"([^/?#]*)(?:[?#].*)?$", 1)
    return files.select(
        key, name.alias("file_name"), F.octet_length(content).cast("bigint").alias("size"), F.lit(fmt).alias("format")
    )


def enrich(docs: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Attach metadata columns by key; documents without facts keep nulls."""
    return docs.join(facts, key, "left")


def extract_fields(df: DataFrame, text: str, rules: dict[str, str], out: str = "fields") -> DataFrame:
    """`map<field, value>` from `{field: pattern with one group}`; absent fields are left out."""
    pairs = []
    for field, pattern in rules.items():
        hits = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
        pairs.append(F.struct(F.lit(field).alias("key"), F.get(hits, F.lit(0)).alias("value")))
    present = F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())
    return df.withColumn(out, F.map_from_entries(present))
