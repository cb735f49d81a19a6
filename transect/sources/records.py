"""Profile images (.3dc): fixed-width records of header, intensities and raw heights; files to profile rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.config import COLUMNS
from transect.sources.quicklz import decompress

#: Records of a file as the scanner writes it; only told, a file's size decides.
PROFILES = 900


def decode_records(data: bytes, columns: int = COLUMNS, reverse: bool = True, expected: int | None = None) -> np.ndarray:
    """Structured array (header, intensity, heights) of decompressed bytes; columns in public order, which is the reverse of the file's."""
    if columns <= 0:
        raise ValueError("columns must be positive")
    width = 8 + 3 * columns
    if not data or len(data) % width:
        raise ValueError(f"{len(data)} bytes are not a positive multiple of the record size {width}")
    rows = np.frombuffer(data, np.dtype([("header", "V8"), ("intensity", "u1", (columns,)), ("heights", "<u2", (columns,))]))
    if expected is not None and len(rows) != expected:
        raise ValueError(f"{len(rows)} profiles where {expected} were expected")
    if reverse:
        rows = rows.copy()
        rows["intensity"], rows["heights"] = rows["intensity"][:, ::-1].copy(), rows["heights"][:, ::-1].copy()
    return rows


def read_image(content: bytes, columns: int = COLUMNS, reverse: bool = True, expected: int | None = None) -> np.ndarray:
    """decode_records of a QuickLZ block."""
    return decode_records(decompress(content), columns, reverse, expected)


def image_files(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """(path, length, modificationTime[, content]) of all .3dc files under a folder; without content their bodies aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.3dc").option("recursiveFileLookup", "true").load(path)
    return found if content else found.select("path", "length", "modificationTime")


def header_columns(content: Column) -> Column:
    """struct<flags, size, compressed, decompressed, level, streaming, is_compressed> of a QuickLZ header, as an expression; null for a block shorter than its header."""

    def number(at, width):
        each = [F.conv(F.hex(F.substring(content, at + k, 1)), 16, 10).cast("bigint") * (1 << 8 * k) for k in range(width)]
        return sum(each[1:], each[0])

    flags = number(1, 1)
    long = flags.bitwiseAND(2) != 0
    size = F.when(long, 9).otherwise(3)
    fields = F.struct(
        flags.alias("flags"), size.alias("size"), F.when(long, number(2, 4)).otherwise(number(2, 1)).alias("compressed"), F.when(long, number(6, 4)).otherwise(number(3, 1)).alias("decompressed"),
        F.shiftright(flags, 2).bitwiseAND(3).alias("level"), F.shiftright(flags, 4).bitwiseAND(3).alias("streaming"), (flags.bitwiseAND(1) != 0).alias("is_compressed"),
    )
    return F.when((F.octet_length(content) >= 1) & (F.octet_length(content) >= size), fields)


def decompressed(block: Column) -> Column:
    """The bytes of small QuickLZ blocks, an Arrow batch of them at a time."""

    @F.pandas_udf("binary")
    def each(blocks: pd.Series) -> pd.Series:
        return blocks.map(lambda b: decompress(bytes(b)))

    return each(block)


def profiles(files: DataFrame, columns: int = COLUMNS, reverse: bool = True) -> DataFrame:
    """(path, row_index, header, intensity, raw_heights, error), one row for each profile; one with an error for a file that can't be decoded.

    One file's content is in memory at a time; its rows leave in batches of 64.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "row_index", "header", "intensity", "raw_heights", "error"]
        kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.string()]
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    rows = read_image(content.as_py(), columns, reverse)
                except ValueError as e:
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((path, None, None, None, None, str(e)), kinds, strict=True)], names=names)
                    continue
                for k in range(0, len(rows), 64):
                    part = rows[k : k + 64]
                    values = ([path] * len(part), list(range(k, k + len(part))), [bytes(h) for h in part["header"]], [i.tobytes() for i in part["intensity"]], [h.tolist() for h in part["heights"]], [None] * len(part))
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)

    return files.select("path", "content").mapInArrow(work, "path string, row_index int, header binary, intensity binary, raw_heights array<int>, error string")


def profile_at(rows: DataFrame, index: int) -> DataFrame:
    """The profile of each file at an index; a negative one counts from the file's end. No row where a file has none there."""
    if index >= 0:
        return rows.filter(F.col("row_index") == index)
    sizes = rows.groupBy("path").agg((F.max("row_index") + 1 + index).alias("wanted"))
    return rows.join(sizes, "path").filter("row_index = wanted AND wanted >= 0").drop("wanted")
