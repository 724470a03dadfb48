"""Raw files and Parquet chunks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_PER_FOLDER = 1000
PIECE_BYTES = 1 << 25
WHOLE_BYTES = 1 << 28  # of the largest file that one task hashes, and of the part of a larger one that it takes


def _binary(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """`path, modificationTime, length`; file contents are not read."""
    return _binary(spark, path, glob).select("path", "modificationTime", "length")


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """File rows with `content`, whole. A file beyond the reader's own limit
    (`spark.sql.sources.binaryFile.maxLength`) fails the job; none is passed over."""
    return _binary(spark, path, glob)


def read_files_sql(path: str, columns: str = "path, length") -> str:
    """SQL text that reads files as rows."""
    quoted = path.replace("`", "``")
    return f"SELECT {columns} FROM binaryFile.`{quoted}`"


def read_pieces(listed: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """`path, length, start, content`: the whole content of the files `listed(path, length)` in pieces, each read by the task
    that its row goes to. So a file may be of any size; one of no bytes has one empty piece."""
    step = F.lit(piece_bytes).cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), step)
    cut = listed.select("path", "length", F.explode(starts).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                system, path = fs.FileSystem.from_uri(quote(row["path"], safe="/:@"))
                with system.open_input_file(path) as file:
                    content = file.read_at(min(piece_bytes, row["length"] - row["start"]), row["start"])
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([content], pa.binary())], [*one.schema.names, "content"])

    dealt = cut.repartition(max(1, cut.count()), "path", "start")
    return dealt.mapInArrow(read, "path string, length bigint, start bigint, content binary")


def _hash_part(length: int, begin: int, state: bytes | None, file, n: int) -> tuple[bytes | None, str | None]:
    """SHA-256 of a file carried on by `n` bytes from `begin`: its state there, or at the end of the file the digest.

    The library behind hashlib keeps its state in 112 plain bytes (`SHA256_CTX`), which hashlib itself does not hand out.
    """
    import _hashlib

    sha, context = ctypes.CDLL(_hashlib.__file__), ctypes.create_string_buffer(state or b"", 112)
    if state is None:
        sha.SHA256_Init(context)
    file.seek(begin)
    end = min(begin + n, length)
    while begin < end:
        content = file.read(min(PIECE_BYTES, end - begin))
        if not content:
            raise EOFError(f"a file of {length} bytes ended at {begin}")
        sha.SHA256_Update(context, content, ctypes.c_size_t(len(content)))
        begin += len(content)
    if end < length:
        return context.raw, None
    digest = ctypes.create_string_buffer(32)
    sha.SHA256_Final(digest, context)
    return None, digest.raw.hex()


def sha256_in_parts(listed: DataFrame, part_bytes: int = WHOLE_BYTES) -> DataFrame:
    """`path, length, sha256` of the whole files `listed(path, length)`, of any size. The hash runs over a file in order, so
    its parts are read one after the other, each by a task of its own that hands the state on to the next."""
    n_files, longest = listed.agg(F.count("*"), F.coalesce(F.max("length"), F.lit(0))).first()
    none = F.lit(None)
    rows = listed.select("path", "length", none.cast("binary").alias("state"), none.cast("string").alias("sha256"))

    def part(begin: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            for batch in batches:
                states, digests = [], []
                for row in batch.to_pylist():
                    found = row["state"], row["sha256"]
                    if row["sha256"] is None:
                        system, path = fs.FileSystem.from_uri(quote(row["path"], safe="/:@"))
                        with system.open_input_file(path) as file:
                            found = _hash_part(row["length"], begin, row["state"], file, part_bytes)
                    states.append(found[0])
                    digests.append(found[1])
                done = [*batch.columns[:2], pa.array(states, pa.binary()), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(done, names=batch.schema.names)

        return run

    for begin in range(0, max(1, longest), part_bytes):
        # Four times as many tasks as files, so that few of them meet in one.
        rows = rows.repartition(max(1, 4 * n_files), "path").mapInArrow(part(begin), rows.schema)
    return rows.select("path", "length", "sha256")


def sha256_of(spark: SparkSession, path: str, glob: str | None = None, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """`path, length, sha256` of whole files. Those of up to `whole_bytes` come through Spark's reader, one task a file;
    of a larger one no task reads more than that."""
    small = F.col("length") <= whole_bytes
    whole = read_files(spark, path, glob).where(small).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = list_files(spark, path, glob).where(~small)
    if large.isEmpty():
        return whole
    return whole.unionByName(sha256_in_parts(large.select("path", "length"), whole_bytes))


def write_texts(rows: DataFrame, key: str, text: str, folder: str, prefix: str) -> int:
    """One file `<prefix><key>.txt` a key below `folder`, and how many there are: its texts, each ended by a newline; a null
    text is an empty line, a null key an empty name.

    A task fills folders of its own with some hundred files each, so that listing them is not a call a file.
    Files get their names once they are whole: a task that runs again replaces them.
    """
    spark = rows.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    slim = rows.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(uri)
        task = TaskContext.get()
        own, open_key, out, n = f"{root}/part-{task.partitionId()}", None, None, 0
        unfinished = f"{own}/attempt-{task.taskAttemptId()}.unfinished"

        def close() -> None:
            out.close()
            system.move(unfinished, f"{own}/{prefix}{quote(open_key or '', safe='')}.txt")

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if out is None or name != open_key:
                    if out is None:
                        system.create_dir(own, recursive=True)
                    else:
                        close()
                    open_key, out, n = name, system.open_output_stream(unfinished), n + 1
                out.write((content or b"") + b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    parts = max(1, -(-slim.count() // FILES_PER_FOLDER))
    placed = slim.repartition(parts, "key").sortWithinPartitions("key", "text")
    return placed.mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Parquet chunks straight into a distributed DataFrame."""
    return spark.read.parquet(path)


def sample_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first `n` rows by key, so the sample is the same on every run."""
    return df.orderBy(key).limit(n)


def check_assets_path(input_path: str, assets_path: str) -> str:
    """Derived files inside the input tree would be parsed again on the next scan."""
    root, target = input_path.rstrip("/") + "/", assets_path.rstrip("/") + "/"
    if target.startswith(root):
        raise ValueError(f"write assets outside the input folder: {assets_path}")
    return assets_path
