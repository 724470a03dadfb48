"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}
_announced: set[str] = set()


def get_session(app: str = "docsift", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans rely on; `conf` adds to them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="docsift-")
    return _local_dirs[app]


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one; it is deleted when the session ends."""
    path = f"{shared_dir(spark)}/docsift-{spark.sparkContext.applicationId}"
    if path not in _announced:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _announced.add(path)
    return path


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing has written to yet."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession) -> str:
    """Catalog database of this application, placed in the shared folder."""
    name = "docsift_" + re.sub(r"\W+", "_", spark.sparkContext.applicationId).lower()
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_dir(spark)}/{name}'")
    return name


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write `df` once below the shared folder and read it back.

    Used where one result feeds several jobs: the copy outlives lost executors
    and cuts the lineage.
    """
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, n_rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint `df` for broadcast when its counted rows are few; else leave the join
    to a shuffle on its key."""
    return F.broadcast(df) if n_rows <= limit else df


def counted(spark: SparkSession, df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`df` written once, and how many rows it has."""
    stored = written(spark, df, label)
    return stored, stored.count()
