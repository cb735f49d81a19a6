"""Image files (.3dc) of all sets as a Spark data source: spark.read.format("threedc").load(root).

Planning lists the folder once and reads names only; the driver holds one small entry for each file that is left, as for
any of Spark's file sources. Sets and start frames, which a name tells, are chosen there, before anything is opened; what
is left is put in order and cut into partitions of about `split_bytes`, so many small files are one task and a large set
is many. A task decodes one file after the other and gives its profiles away in Arrow batches of 64.

Options: sets (comma-separated), from_frame and to_frame (start frames, both ends included), columns (1536), reverse (true),
fps (30), split_bytes (64 MB). Which files are read is asked by options and not by filters that Spark hands down: Spark
4.1.2 keeps what a Python source was last asked for with the relation, and a DataFrame that is used twice, as in a union or
a self-join, then gets the rows of the other's filter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from transect.config import COLUMNS
from transect.functions.scalars import frame_number
from transect.plans.files import store
from transect.sources.records import read_image

SCHEMA = "path string, set_id string, relative_path string, file_number int, length bigint, start_frame double, row_index int, header binary, intensity binary, raw_heights array<int>, error string"
NAMES = [c.split(" ")[0] for c in SCHEMA.split(", ")]
KINDS = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.string()]
SPLIT_BYTES, BATCH_ROWS = 64 << 20, 64

@dataclass(frozen=True)
class Image:
    """What a listing says of a file; file_number is its place among those that are read."""

    path: str
    set_id: str | None
    relative_path: str
    start_frame: float | None
    length: int


@dataclass
class Images(InputPartition):
    """Files of one task, with the number of the first."""

    first: int
    files: list[Image] = field(default_factory=list)


def listed(root: str, fps: int = 30, set_passes=lambda set_id: True) -> list[Image]:
    """The .3dc files under a folder in order of set, start frame and path. A set is a folder of digits directly under root; of other files the set is null and the path relative to root. Sets that don't pass aren't listed."""
    fs, base = store(root)
    base, root = base.rstrip("/"), root.rstrip("/")
    found, wanted = [], pafs.FileType.File
    for top in fs.get_file_info(pafs.FileSelector(base)):
        set_id = top.base_name if top.type == pafs.FileType.Directory and re.fullmatch("[0-9]+", top.base_name) else None
        if not set_passes(set_id):
            continue
        for f in [top] if top.type == wanted else fs.get_file_info(pafs.FileSelector(top.path, recursive=True)):
            if f.type == wanted and f.path.endswith(".3dc"):
                rest = f.path[len(base) + 1 :]
                found.append(Image(f"{root}/{rest}", set_id, rest if set_id is None else rest[len(set_id) + 1 :], frame_number(f.base_name.removesuffix(".3dc"), fps), f.size))
    return sorted(found, key=lambda x: (x.set_id is None, int(x.set_id or 0), x.set_id or "", x.start_frame is None, x.start_frame or 0.0, x.relative_path.lower(), x.relative_path))


class ThreeDcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.fps = options["path"], int(options.get("fps", 30))
        self.columns, self.reverse = int(options.get("columns", COLUMNS)), str(options.get("reverse", "true")).lower() == "true"
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        if self.columns <= 0 or self.split_bytes <= 0:
            raise ValueError("columns and split_bytes must be positive")
        self.sets = None if options.get("sets") is None else {s for s in options["sets"].split(",") if s}
        self.from_frame, self.to_frame = (None if options.get(k) is None else float(options[k]) for k in ("from_frame", "to_frame"))

    def passes(self, frame: float | None) -> bool:
        """Whether a start frame is in the range that is asked for; none is in no range."""
        if self.from_frame is None and self.to_frame is None:
            return True
        return frame is not None and (self.from_frame is None or frame >= self.from_frame) and (self.to_frame is None or frame <= self.to_frame)

    def partitions(self) -> list[InputPartition]:
        chosen = [f for f in listed(self.root, self.fps, lambda s: self.sets is None or s in self.sets) if self.passes(f.start_frame)]
        out, size = [], 0
        for k, f in enumerate(chosen):
            if not out or size + f.length > self.split_bytes:
                out.append(Images(k))
                size = 0
            out[-1].files.append(f)
            size += f.length
        return out or [Images(0)]  # for no partition Spark would call read() without one

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for k, f in enumerate(partition.files):
            fs, at = store(f.path)
            told = (f.path, f.set_id, f.relative_path, partition.first + k, f.length, f.start_frame)
            try:
                with fs.open_input_file(at) as body:
                    rows = read_image(body.read(), self.columns, self.reverse)
            except (OSError, ValueError) as e:
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*told, None, None, None, None, f"{type(e).__name__}: {e}"), KINDS, strict=True)], names=NAMES)
                continue
            for i in range(0, len(rows), BATCH_ROWS):
                part = rows[i : i + BATCH_ROWS]
                n = len(part)
                heights = pa.ListArray.from_arrays(pa.array(range(0, (n + 1) * self.columns, self.columns), pa.int32()), pa.array(part["heights"].astype("i4").ravel()))
                values = [*([v] * n for v in told), list(range(i, i + n)), [bytes(h) for h in part["header"]], [x.tobytes() for x in part["intensity"]]]
                yield pa.RecordBatch.from_arrays([*(pa.array(v, t) for v, t in zip(values, KINDS, strict=False)), heights, pa.array([None] * n, pa.string())], names=NAMES)


class ThreeDc(DataSource):
    """One row for each profile; a file that can't be read or decoded is one row with an error."""

    @classmethod
    def name(cls) -> str:
        return "threedc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        if "path" not in self.options:
            raise ValueError("load() takes the survey's folder")
        return ThreeDcReader(self.options)


def read_survey(spark: SparkSession, root: str, sets: list[str] | None = None, from_frame: float | None = None, to_frame: float | None = None, **options) -> DataFrame:
    """Profiles of the image files under root/<set>/..., of some sets and start frames if those are given. Registers the source with the session."""
    spark.dataSource.register(ThreeDc)
    asked = {"sets": None if sets is None else ",".join(sets), "from_frame": from_frame, "to_frame": to_frame}
    return spark.read.format("threedc").options(**{k: v for k, v in (asked | options).items() if v is not None}).load(root)
