"""Catalog tables: overwrite, additive schemas, change-feed flag."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANGE_FEED = "changefeed.enabled"


def overwrite(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.format("parquet").mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def overwrite_merging_schema(df: DataFrame, table: str) -> None:
    """Replace the rows and keep columns that only the old table had, as nulls."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        have = {c.lower() for c in df.columns}
        for field in spark.table(table).schema:
            if field.name.lower() not in have:
                df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    overwrite(df, table)


def append_merging_schema(df: DataFrame, table: str, merged: str) -> None:
    """Old and new rows under the union of both schemas, written as table `merged`."""
    overwrite(df.sparkSession.table(table).unionByName(df, allowMissingColumns=True), merged)


def register_parquet(spark: SparkSession, table: str, path: str) -> None:
    """Catalog entry over existing files; dropping it leaves them alone."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _metadata(spark: SparkSession, table: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(table))


def side_folder(spark: SparkSession, table: str) -> str | None:
    """URI of a new folder in that of the table, hidden from its readers, for files that tasks write and `adopt` moves;
    None if Arrow does not open the store."""
    from pyarrow import fs

    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_metadata(spark, table).location())
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = quote(f"{store.makeQualified(at).toString()}/.files-{uuid.uuid4().hex[:12]}", safe="/:@")
    try:
        system, path = fs.FileSystem.from_uri(uri)
        system.create_dir(path, recursive=True)
    except (OSError, ValueError, NotImplementedError):
        return None
    return uri


def adopt(spark: SparkSession, table: str, partition: str, folder: str, names: list[str]) -> None:
    """Move the Parquet files `names` of a `side_folder` into a partition (`column=value`) of the table, and drop the folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    kept = _metadata(spark, table)
    root = path(kept.location())
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    side, target = path(root, folder.rsplit("/", 1)[1]), path(root, partition)
    store.mkdirs(target)
    for name in names:
        if not store.rename(path(side, name), path(target, name)):
            raise OSError(f"cannot move {name} to {target}")
    store.delete(side, True)
    if kept.tracksPartitionsInCatalog():
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({partition})")
    spark.catalog.refreshTable(table)


def enable_change_feed(spark: SparkSession, table: str, prop: str = CHANGE_FEED) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{prop}' = 'true')")


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def change_feed_enabled(spark: SparkSession, table: str, prop: str = CHANGE_FEED) -> bool:
    return properties(spark, table).get(prop, "false") == "true"


def require_change_feed(spark: SparkSession, table: str, prop: str = CHANGE_FEED) -> None:
    if not change_feed_enabled(spark, table, prop):
        raise ValueError(f"table {table} has no change feed; set '{prop}' to true")
