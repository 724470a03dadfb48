"""Written intermediates and task-side files in the folder all machines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.session import fresh_path

ROWS_A_TASK = 1 << 17  # rows of some whole numbers that one task groups and joins


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def folder(spark: SparkSession, label: str) -> str:
    """A new folder of the session's scratch, as a URI; it goes when the session ends."""
    fs, at = _hadoop(spark, fresh_path(spark, f"llm-{label}"))
    fs.mkdirs(at)
    return fs.makeQualified(at).toString()


def keep(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """`df` written once and read back: later jobs start from the copy, which outlives
    lost executors."""
    path = folder(spark, label) + "/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, n_rows: int) -> DataFrame:
    """`df`, whose rows are a few numbers each and were counted, in as many partitions as they need. Where one
    is enough, grouping and joining them takes no shuffles; more are shuffled as usual."""
    return df.coalesce(max(1, -(-n_rows // ROWS_A_TASK)))


def drop(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files that a DataFrame made by `keep` reads, once it is used up."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        fs, at = _hadoop(spark, path)
        fs.delete(at, True)


def opened(uri: str):
    """Arrow's file system for a URI, and the path in it; for use inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def settle(spark: SparkSession) -> SparkSession:
    """Bound the rows that go to a Python worker at a time; texts of a few kB make some MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def place(docs: DataFrame, name: str) -> int:
    """Where the column `name` stands: the one spelled so, else one that differs in case only."""
    names = docs.columns
    return names.index(name) if name in names else [n.lower() for n in names].index(name.lower())


def numbered(docs: DataFrame) -> DataFrame:
    """All columns as `c0, c1, ...`, so that none of any name (dots, names in use inside, repeated
    ones) is in the way; `toDF(*docs.columns)` gives the names back."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def text_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_type: str = "long") -> DataFrame:
    """The two columns an operator reads, under fixed names, whatever else the table has."""
    key, text = (F.col(f"c{place(docs, n)}") for n in (id_col, text_col))
    return numbered(docs).select(key.cast(id_type).alias("doc_id"), text.cast("string").alias("text"))
