"""One file from many tasks, in order: rows as bytes, written where they belong.

Rows are sorted into ranges, and the task of a range renders its rows and writes them as a part of its own. The parts'
lengths, one number a task, tell where each begins in the file; then tasks copy the parts to their places, each into its
own stretch of one file, which gets its name when all are done. The driver sees names and lengths only. A store without
writes at a place (most object stores) gets the parts one after the other through one stream, in blocks.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from transect.plans.files import store
from transect.plans.ranking import tasks_of

BLOCK = 8 << 20
#: Bytes that a task holds before it writes them.
HELD = 1 << 20


def write_ordered(rows: DataFrame, order: list[Column | str], path: str, render: Callable[[dict], bytes], head: bytes = b"", between: bytes = b"", tail: bytes = b"") -> int:
    """Write a file: head, render(row) of each row in order with `between` between them, tail; how many rows.

    Rows that `order` doesn't tell apart stand in any order. The file appears whole or not at all; one of that name is
    replaced. Tasks that run again write parts of other names, and what no part list names goes with the parts' folder.
    """
    fs, at = store(path)
    folder, _, name = at.rpartition("/")
    mark = uuid.uuid4().hex
    parts_at, made = f"{folder}/.{name}.{mark}.parts", f"{folder}/.{name}.{mark}.tmp"
    fs.create_dir(parts_at, recursive=True)
    parts_uri = f"{path.rstrip('/').rpartition('/')[0]}/.{name}.{mark}.parts"
    spark = rows.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, held, waiting, size, n = uuid.uuid4().hex, None, [], 0, 0, 0
        to, base = store(parts_uri)
        try:
            for b in batches:
                for row in b.to_pylist():
                    body = render(row)
                    held += (between, body) if n else (body,)
                    waiting += len(body) + (len(between) if n else 0)
                    n += 1
                    if out is None:
                        out = to.open_output_stream(f"{base}/{part}")
                    if waiting >= HELD:
                        out.write(b"".join(held))
                        held, waiting, size = [], 0, size + waiting
            if out is not None:
                out.write(b"".join(held))
                size += waiting
        finally:
            if out is not None:
                out.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([part]), pa.array([size]), pa.array([n])], names=["range", "part", "size", "rows"])

    try:
        ranged = rows.repartitionByRange(tasks_of(spark), *order).sortWithinPartitions(*order)
        parts = sorted(ranged.mapInArrow(write, "range bigint, part string, size bigint, rows bigint").collect())
        places, end = [], len(head)
        for p in parts:
            places.append((p.part, end))
            end += p.size + len(between)
        end -= len(between) if parts else 0
        if isinstance(fs, pafs.LocalFileSystem):
            with open(made, "wb") as f:
                f.write(head)
                f.truncate(end)
                f.seek(end)
                f.write(tail)
            if places:
                task = spark.createDataFrame(places, "part string, place bigint").repartition(len(places), "part")
                task.mapInArrow(_copier(parts_uri, made, between, end), "part string").write.format("noop").mode("overwrite").save()
        else:
            with fs.open_output_stream(made) as out:
                out.write(head)
                for k, (part, _) in enumerate(places):
                    out.write(between if k else b"")
                    for block in _blocks(fs, f"{parts_at}/{part}"):
                        out.write(block)
                out.write(tail)
        fs.move(made, at)
    except BaseException:
        if fs.get_file_info(made).type != pafs.FileType.NotFound:
            fs.delete_file(made)
        raise
    finally:
        fs.delete_dir(parts_at)
    return sum(p.rows for p in parts)


def _blocks(fs: pafs.FileSystem, at: str) -> Iterator[bytes]:
    with fs.open_input_stream(at) as f:
        while block := f.read(BLOCK):
            yield block


def _copier(parts_uri: str, made: str, between: bytes, end: int):
    """Copies parts to their places in the file `made`, with `between` after each but the last."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(parts_uri)
        for b in batches:
            for part, place in zip(*(c.to_pylist() for c in b.columns), strict=True):
                to = os.open(made, os.O_WRONLY)
                try:
                    for block in _blocks(fs, f"{base}/{part}"):
                        while block:
                            done = os.pwrite(to, block, place)
                            block, place = block[done:], place + done
                    if place < end:
                        os.pwrite(to, between, place)
                    os.fsync(to)
                finally:
                    os.close(to)
            yield b.select(["part"])

    return copy
