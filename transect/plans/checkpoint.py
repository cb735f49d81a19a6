"""Resumable results: a Parquet table for each fingerprint of calibration, options and source, appended chunk by chunk.

A file's result is reused if its index row and its identity (size, time of change, hash of its first, middle and last
4 KiB) are the same and it was ok; the latest row of a key counts. Spark's commit makes each chunk whole or absent.
"""

from __future__ import annotations

import json
import os
import socket
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transect import schemas
from transect.plans.files import exists, store

SCHEMA_VERSION = 1
PROBE_BYTES = 4096
IDENTITY = "relative_path string, size bigint, changed bigint, probe string"
KEY = ["relative_path", "start_frame", "end_frame", "size", "changed", "probe"]


def fingerprint(set_id: str, set_dir: str, calibration: bytes, options: dict) -> str:
    """Hash of everything that a result depends on but the files themselves."""
    body = {"version": SCHEMA_VERSION, "set": set_id, "source": set_dir.rstrip("/"), "calibration": sha256(calibration).hexdigest(), "options": options}
    return sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), allow_nan=False).encode()).hexdigest()


def probe(read, size: int) -> str:
    """Hash of up to 4 KiB at the start, middle and end of a file, with their places; read(offset, length) gives bytes."""
    digest, n = sha256(f"probe:{size}:".encode()), min(PROBE_BYTES, size)
    for at in sorted({0, max(0, (size - n) // 2), max(0, size - n)}):
        part = read(at, n)
        if len(part) != n:
            raise OSError("the file changed while it was probed")
        digest.update(at.to_bytes(8, "little") + n.to_bytes(8, "little") + part)
    return digest.hexdigest()


def probe_of(content: Column) -> Column:
    """probe() of binary content, as an expression."""

    def little(n: Column) -> Column:
        digits = F.lpad(F.hex(n), 16, "0")
        return F.unhex(F.concat(*[F.substring(digits, 15 - 2 * k, 2) for k in range(8)]))

    size = F.octet_length(content).cast("bigint")
    n = F.least(size, F.lit(PROBE_BYTES))
    places = F.array_distinct(F.array(F.lit(0).cast("bigint"), F.floor((size - n) / 2), size - n))
    parts = F.transform(places, lambda at: F.concat(little(at), little(n), F.substring(content, (at + 1).cast("int"), PROBE_BYTES)))
    whole = F.aggregate(parts, F.concat(F.lit("probe:"), size.cast("string"), F.lit(":")).cast("binary"), lambda a, p: F.concat(a, p))
    return F.when(content.isNotNull(), F.sha2(whole, 256))


def identities(files: DataFrame) -> DataFrame:
    """IDENTITY of files (relative_path, path): 12 KiB of each are read. size -1 for a file that is gone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for relative, path in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, at = store(path)
                info = fs.get_file_info(at)
                if not info.is_file:
                    rows.append((relative, -1, -1, ""))
                    continue
                with fs.open_input_file(at) as f:
                    rows.append((relative, info.size, info.mtime_ns or 0, probe(lambda o, n: f.read_at(n, o), info.size)))  # noqa: B023
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["relative_path", "size", "changed", "probe"])

    return files.select("relative_path", "path").mapInArrow(work, IDENTITY)


class Checkpoint:
    """The table of one fingerprint under a folder."""

    def __init__(self, spark: SparkSession, root: str, print_: str, resume: bool = True):
        self.spark, self.at, self.resume = spark, f"{root.rstrip('/')}/fingerprint={print_}", resume
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @contextmanager
    def locked(self):
        """Hold the table's lock file; RuntimeError if another run has it. Whoever finds one left by a run that died removes it.

        Only the run that holds the lock changes the table: without resume it is emptied here, and a compaction that died is
        finished or undone. The lock that is released is this run's own; one that someone has put in its place stays.
        """
        path, token = self._path(self.at + ".lock"), f"{socket.gethostname()} {os.getpid()} {uuid.uuid4().hex}".encode()
        self._fs.mkdirs(path.getParent())
        try:
            stream = self._fs.create(path, False)
        except Py4JJavaError:
            if not self._fs.exists(path):
                raise
            raise RuntimeError(f"another run holds {path.toString()}") from None
        try:
            stream.write(bytearray(token))
            stream.close()
            self._mend()
            if not self.resume:
                self._delete(self.at)
            yield self
        finally:
            if self._fs.exists(path) and self._read(path) == token:
                self._fs.delete(path, False)

    def _read(self, path) -> bytes:
        stream = self._fs.open(path)
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def _delete(self, at: str) -> None:
        self._fs.delete(self._path(at), True)

    def _mend(self) -> None:
        """After a compaction that died: without a table the merged one, which is whole by then, takes its place; what else was left goes."""
        if not exists(self.at) and exists(self.at + ".merged"):
            self._fs.rename(self._path(self.at + ".merged"), self._path(self.at))
        for left in (".merged", ".before"):
            self._delete(self.at + left)

    def compact(self, most: int = 64) -> bool:
        """Merge the latest entries into a few files if the table has more than `most`; to be called under the lock."""
        if not exists(self.at) or sum(f.getPath().getName().endswith(".parquet") for f in self._fs.listStatus(self._path(self.at))) <= most:
            return False
        self.entries().write.mode("overwrite").parquet(self.at + ".merged")
        self._fs.rename(self._path(self.at), self._path(self.at + ".before"))
        self._fs.rename(self._path(self.at + ".merged"), self._path(self.at))
        self._delete(self.at + ".before")
        return True

    def entries(self) -> DataFrame:
        """The latest entry of each key, FILE_RESULT with the identity."""
        schema = f"{schemas.FILE_RESULT}, size bigint, changed bigint, probe string, written bigint"
        if not exists(self.at):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.at)
        newest = Window.partitionBy(*KEY).orderBy(F.desc("written"))
        return rows.withColumn("k", F.row_number().over(newest)).filter("k = 1").drop("k")

    def reusable(self) -> DataFrame:
        return self.entries().filter("status = 'ok'")

    def append(self, results: DataFrame, written: int) -> None:
        """Add results with their identities; NaN never gets here, missing values are null."""
        results.withColumn("written", F.lit(written).cast("bigint")).write.mode("append").parquet(self.at)
