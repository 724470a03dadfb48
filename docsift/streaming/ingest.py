"""Incremental file ingestion with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.operators import parse
from docsift.sources.files import check_assets_path

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 256
FILE_ROWS = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    """New files below `path`, a bounded number per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def byte_stream(spark: SparkSession, path: str, glob: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """New files below `path`, whole, as rows of bytes."""
    reader = spark.readStream.format("binaryFile").schema(FILE_ROWS).option("maxFilesPerTrigger", files_per_trigger)
    reader = reader.option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def ingest(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything that is available now to Parquet files at `target`, then stop.

    The checkpoint remembers the files taken, so a rerun adds only new ones.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def _folder(target: str, layer: str, number: int) -> str:
    return f"{target}/{layer}/batch={number}"


def ingest_parsed(
    spark: SparkSession, path: str, target: str, checkpoint: str, glob: str | None = None, files_per_trigger: int = 1000
) -> None:
    """Files below `path` that are new, decoded and parsed, then stop. Below `target` lie

    `files`       the decoded text, size and status of every file
    `elements`    the elements of the good ones
    `quarantine`  path, size and status of the others

    each with one folder a micro-batch. A batch that is run again after a failure replaces its own
    folders, so every file counts once; the text is decoded once and parsed from the stored copy. Files
    of no bytes hold no elements, and the reader passes over them. The
    target must lie outside the input folder, whose files would else be taken again.
    """
    check_assets_path(path, target)

    def commit(batch: DataFrame, number: int) -> None:
        stored = _folder(target, "files", number)
        rows = parse.decoded(batch, "path", "content")
        rows.write.mode("overwrite").parquet(stored)
        rows = spark.read.schema(rows.schema).parquet(stored)
        good = rows.filter(F.col("error_status").isNull())
        parse.parse_elements(good, "path", "html").write.mode("overwrite").parquet(_folder(target, "elements", number))
        bad = rows.filter(F.col("error_status").isNotNull()).select("path", "size", "error_status")
        bad.write.mode("overwrite").parquet(_folder(target, "quarantine", number))

    stream = byte_stream(spark, path, glob, files_per_trigger)
    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    # A batch lists its files once more, by default in a task a file up to 10,000.
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(LISTING, before)
