"""Small files that the driver writes, and ranged reads, in any store that pyarrow or a mount reaches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_shared_folder(spark: SparkSession) -> None:
    """See to it that checkpoint() has a folder: the cluster's (spark.checkpoint.dir), or one of our own where that is unset in local mode, as in tests."""
    if spark.sparkContext.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(at or tempfile.mkdtemp(prefix="transect-"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    ensure_shared_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of an absolute path or URI, in the forms that Spark gives them."""
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def write_parts(path: str, parts: Iterable[bytes]) -> None:
    """Write a file from parts, under another name until it is whole."""
    fs, at = store(path)
    folder, _, name = at.rpartition("/")
    fs.create_dir(folder, recursive=True)
    made = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    try:
        with fs.open_output_stream(made) as out:
            for p in parts:
                out.write(p)
        fs.move(made, at)
    except BaseException:
        if fs.get_file_info(made).type != pafs.FileType.NotFound:
            fs.delete_file(made)
        raise


def write_text(path: str, text: str) -> None:
    """Write a small text file in one step."""
    write_parts(path, [text.encode()])


def put_files(files: DataFrame) -> DataFrame:
    """(path, size): files (path, content) written by the tasks, each in one step, so that one that runs again leaves the same."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                write_parts(path, [content])
            yield pa.RecordBatch.from_arrays([b.column(0), pc.binary_length(b.column(1)).cast(pa.int64())], names=["path", "size"])

    return files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(work, "path string, size bigint")


def exists(path: str) -> bool:
    fs, at = store(path)
    return fs.get_file_info(at).type != pafs.FileType.NotFound
