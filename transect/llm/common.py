"""What the operators share: the folder that driver and executors both see, stored tables, texts as bytes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.functions.batches import small_batches

_MADE: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). One of our own is set only in local mode, as in tests; on a cluster each executor would write to its own disk."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at or tempfile.mkdtemp(prefix="transect-"))
    return (at or spark.sparkContext.getCheckpointDir()).rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder; release() removes what a session has made."""
    _MADE.append(at := f"{shared_folder(spark)}/transect-{name}-{uuid.uuid4().hex}")
    return at


def made() -> int:
    """How many workspaces this driver has made and not yet released."""
    return len(_MADE)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the workspaces that this driver has made, but for the first `since`; results that read them must have been written by then."""
    while len(_MADE) > since:
        delete(spark, _MADE.pop())


def delete(spark: SparkSession, at: str) -> None:
    """Delete a folder of the shared store."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, at: str) -> DataFrame:
    """The rows of df, written once to `at` and read from there: lineage ends, and a lost executor costs no recomputation."""
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def spread(spark: SparkSession) -> int:
    """Partitions for a shuffle of our own."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def least_hashed(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of df with the least values of `key`, a 64-bit hash, in its order.

    Rows are counted first and those that can't be among the least (but for a chance below one in a billion, which costs a
    few rows) are filtered out where they lie, so what is sorted and sent to the driver doesn't grow with the table.
    """
    total = df.count()
    if total > 8 * n:
        df = df.filter(F.col(key) <= int(-(2**63) + 2**64 * (4 * n / total)))
    return df.orderBy(key, *[c for c in df.columns if c != key]).limit(n)


def arrow_map(df: DataFrame, work, schema) -> DataFrame:
    """df.mapInArrow(work, schema) with little memory in the workers.

    Arrow batches of the session have at most 4 MB from now on (a smaller limit stays), so that a worker's memory follows
    neither the rows of a batch nor their lengths (a longer row is a batch of its own). A worker gives freed memory back
    when its task ends; it lives on beside the executor's other tasks.
    """
    small_batches(df.sparkSession)

    def thrifty(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from work(batches)
        finally:
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return df.mapInArrow(thrifty, schema)


def whole_rows(df: DataFrame) -> DataFrame:
    """The rows of df as one struct column, `row`: whatever its columns are called, nothing clashes with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def columns_of(rows: DataFrame, names: list[str]) -> DataFrame:
    """The inverse of whole_rows."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names])


def groups(values: list[bytes | None], most: int = 4 << 20):
    """Index ranges of values of about `most` bytes each, so that a worker's memory doesn't follow the batch; a longer text is a group of its own."""
    at = size = 0
    for k, v in enumerate(values):
        if size and size + len(v or b"") > most:
            yield at, k
            at, size = k, 0
        size += len(v or b"")
    if at < len(values):
        yield at, len(values)


class Shipped:
    """A broadcast object of this package: sent as bytes in which its class travels too; loaded once a task."""

    def __init__(self, spark: SparkSession, value):
        self._sent, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"_sent": self._sent, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = cloudpickle.loads(self._sent.value)
        return self._value

    def forget(self) -> None:
        """Free a worker's copy; the next use loads it again."""
        self._value = None


def folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in the shared store, by URI or absolute path."""
    return pafs.FileSystem.from_uri(uri)


def put_file(uri: str, name: str, parts: list) -> None:
    """Write a file of these buffers under its name in one step, so that a task that runs again leaves the same whole file."""
    fs, path = folder(uri)
    fs.create_dir(path, recursive=True)
    made = f"{path}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(made) as out:
        for p in parts:
            out.write(p)
    fs.move(made, f"{path}/{name}")


class Opened:
    """Shared files that a worker has open: the last `most` of them, and of those that had to be read, as the store isn't mounted, the last `held` bytes."""

    def __init__(self, uri: str, most: int = 1024, held: int = 256 << 20):
        self.uri, self.most, self.held = uri, most, held
        self._files: OrderedDict[str, np.ndarray] = OrderedDict()
        self.bytes_read = 0

    def __len__(self) -> int:
        return len(self._files)

    def __getitem__(self, name: str) -> np.ndarray:
        """The bytes of a file; FileNotFoundError if it is gone, so that no result is made without it."""
        if name in self._files:
            self._files.move_to_end(name)
            return self._files[name]
        self._files[name] = found = mapped(self.uri, name)
        self.bytes_read += self._read(found)
        while len(self._files) > self.most or (self.bytes_read > self.held and len(self._files) > 1):
            self.bytes_read -= self._read(self._files.popitem(last=False)[1])
        return found

    @staticmethod
    def _read(data: np.ndarray) -> int:
        return 0 if isinstance(data, np.memmap) else data.nbytes


class Filled:
    """Which of n ranges have a file, one bit each."""

    def __init__(self, n: int, parts):
        bits = np.zeros(n, bool)
        bits[list(parts)] = True
        self._bits = np.packbits(bits)

    def __contains__(self, part: int) -> bool:
        return bool(self._bits[part >> 3] >> (7 - (part & 7)) & 1)


def mapped(uri: str, name: str) -> np.ndarray:
    """The bytes of a shared file: memory-mapped where the store is a mounted file system, else read."""
    fs, path = folder(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", np.uint8, "r") if os.stat(f"{path}/{name}").st_size else np.zeros(0, np.uint8)
    with fs.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), np.uint8)
