"""From raw documents to token ids: five stages, each over all that its predecessor kept.

1. quality: documents that the classifier rejects go.
2. lines: lines of any length whose template an earlier document has go, and documents of which nothing
   else is left.
3. near_duplicates: of each group of near-duplicates (five-word shingles, 0.8) the document
   with the smallest id stays.
4. decontaminate: documents with at least a twentieth of their words in benchmark windows go.
5. bpe: ids of what is left, with the digests that decoding them gives.

Every stage keeps the columns of `documents`, whatever their names; the last returns `doc_id, n_tokens,
ids, ids_sha256, decoded_sha256`. Null texts are empty texts to the classifier; rows with null id
pass the stages that go by id; rows that share an id are one document to the lines, one node to the near
duplicates, and rows of their own otherwise. Of tied texts the smallest id stays. Texts may be of any length; empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import bpe, decontaminate, line_templates, near_duplicates, quality, store
from docsift.llm.queries import vocabulary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = store.load(store.settle(spark), sf_dir, "labels")
    return quality.keep_good(spark, docs, labels.select(F.col("doc_id").cast("long"), F.col("quality").alias("y")))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    length = "n_chars" if "n_chars" in docs.columns else None
    return line_templates.drop_recurring(store.settle(spark), docs, length_col=length)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.drop_copies(store.settle(spark), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(store.settle(spark), docs, store.load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    ids = bpe.encode(store.settle(spark), store.text_of(docs), ranks)
    return bpe.digests(bpe.decode(ids, ranks), "ids")


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_recurring_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: The classifier is trained, and no SQL states it; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again by the next."""
    docs = store.load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.keep(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
