"""Survey folders: sets, file index with frame intervals, GPS and heading."""

from __future__ import annotations

import json
import re
from datetime import UTC, datetime
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transect.functions.scalars import frame_of, is_close, stem_of
from transect.plans.files import ensure_shared_folder, write_text
from transect.plans.ranking import MOST_BROADCAST, tasks_of
from transect.sources.records import image_files


def sets_of(files: DataFrame, root: str) -> DataFrame:
    """(set_id, n_files) of image files under root/<digits>/...; set ids are labels, so 007 and 7 are two sets. In numeric order."""
    rest = below(F.col("path"), root)
    found = files.select(F.regexp_extract(rest, "^([0-9]+)/", 1).alias("set_id")).filter("set_id <> ''")
    return found.groupBy("set_id").agg(F.count("*").alias("n_files")).orderBy(F.col("set_id").cast("decimal(38,0)"), "set_id")


def discover_sets(spark: SparkSession, root: str, requested: list[str] | None = None) -> list[str]:
    """Set labels under root in numeric order; of those requested, each must exist and none may come twice. ValueError otherwise, or if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []
    there = [x for x in there if x.isdigit()]
    if requested is not None:
        twice = sorted({x for x in requested if requested.count(x) > 1})
        missing = sorted(set(requested) - set(there))
        if twice or missing:
            raise ValueError(f"requested sets: {twice} more than once, {missing} not found")
        there = list(requested)
    if not there:
        raise ValueError(f"no numeric set folder under {root}")
    return sorted(there, key=lambda x: (int(x), x))


def file_pattern(path: str) -> str:
    """A pattern that only `path` matches, for file streams: they take a plain path for a folder, a pattern may name a file, too."""
    path = path.rstrip("/")
    if not path[-1:].isalnum():
        raise ValueError(f"the last character of {path!r} must be a letter or a digit")
    return f"{path[:-1]}[{path[-1]}]"


def below(path: Column, root: str) -> Column:
    """What follows the folder `root` in a path, with or without a scheme; null outside it."""
    plain, base = F.regexp_replace(path, "^[a-z0-9]+:/+", "/"), re.sub("^[a-z0-9]+:/+", "/", root).rstrip("/") + "/"
    return F.when(F.startswith(plain, F.lit(base)), F.substring(plain, len(base) + 1, 1 << 30))


def end_frames(index: DataFrame) -> DataFrame:
    """(set_id, relative_path, start_frame, end_frame): a file ends where the next one of its set begins, if that is later; else after the set's median positive step (1 without one).

    Files are in order of start frame, then of path without case. They are sorted into ranges, so a large set is many tasks:
    each range looks up its own next files, and its last one the first of the next range. The median is that of counts of
    steps, which are few for whole frames: n different ones span at least n (n + 1) / 2 frames.
    """
    spark = index.sparkSession
    ensure_shared_folder(spark)
    tasks, order = tasks_of(spark), ["start_frame", F.lower("relative_path"), "relative_path"]
    ranged = index.select("set_id", "relative_path", "start_frame").repartitionByRange(tasks, "set_id", *order).withColumn("__range", F.spark_partition_id()).checkpoint()
    after = F.lead("head").over(Window.partitionBy("set_id").orderBy("__range"))
    heads = ranged.groupBy("set_id", "__range").agg(F.min("start_frame").alias("head")).select("set_id", "__range", after.alias("after"))
    following = F.lead("start_frame").over(Window.partitionBy("__range", "set_id").orderBy(*order))
    rows = ranged.repartition(tasks, "__range").withColumn("next", following).join(_small(heads), ["set_id", "__range"]).withColumn("next", F.coalesce("next", "after"))
    step = rows.withColumn("step", F.when(F.col("next") > F.col("start_frame"), F.col("next") - F.col("start_frame")))
    steps = step.filter("step IS NOT NULL").groupBy("set_id", "step").agg(F.count("*").alias("n"))
    usual = steps.groupBy("set_id").agg(F.percentile("step", 0.5, F.col("n")).alias("usual")).checkpoint()
    out = step.join(_small(usual), "set_id", "left")
    return out.select("set_id", "relative_path", "start_frame", F.when(F.col("step").isNotNull(), F.col("next")).otherwise(F.col("start_frame") + F.coalesce("usual", F.lit(1.0))).alias("end_frame"))


def _small(rows: DataFrame) -> DataFrame:
    """rows, to be broadcast if they are few enough: a set may have most files, so joins by set take no shuffle where they can."""
    return F.broadcast(rows) if rows.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else rows


def build_index(spark: SparkSession, set_dir: str, fps: int = 30) -> DataFrame:
    """Index of the image files of one set; names without a time code are left out. ValueError if none is left."""
    set_id = PurePosixPath(set_dir.rstrip("/")).name
    files = image_files(spark, set_dir, content=False)
    found = files.select(F.lit(set_id).alias("set_id"), below(F.col("path"), set_dir).alias("relative_path"), frame_of(stem_of(F.col("path")), fps).alias("start_frame")).filter("start_frame IS NOT NULL")
    out = end_frames(found)
    if out.isEmpty():
        raise ValueError(f"no image file with a time code under {set_dir}")
    return out


def write_index(index: DataFrame, path: str) -> None:
    """Write an index of one set as JSON: schema version 1, set, records in order. A small file of the driver."""
    rows = index.orderBy("start_frame", F.lower("relative_path"), "relative_path").collect()
    records = [{"relative_path": r.relative_path, "start_frame": r.start_frame, "end_frame": r.end_frame} for r in rows]
    body = {"schema_version": 1, "created_at": datetime.now(UTC).isoformat(timespec="seconds"), "set": rows[0].set_id if rows else None, "records": records}
    write_text(path, json.dumps(body, indent=2))


def read_index(spark: SparkSession, path: str, set_id: str) -> DataFrame:
    """(pos, set_id, relative_path, start_frame, end_frame) of an index JSON in stored order; ValueError for another schema or set, a path that leaves the set, or no record."""
    schema = "schema_version int, set string, records array<struct<relative_path:string,start_frame:double,end_frame:double>>"
    body = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    head = body.select("schema_version", "set", F.size("records").alias("n")).first()
    if head is None or head.schema_version != 1:
        raise ValueError(f"unsupported index schema in {path}")
    if head.set != set_id:
        raise ValueError(f"the index is of set {head.set!r}, not {set_id!r}")
    if head.n is None or head.n <= 0:
        raise ValueError(f"the index {path} has no records")
    rows = body.select(F.lit(set_id).alias("set_id"), F.posexplode("records").alias("pos", "r")).select("pos", "set_id", "r.*")
    unsafe = rows.filter(F.col("relative_path").startswith("/") | F.exists(F.split("relative_path", r"[/\\]"), lambda x: x == "..")).first()
    if unsafe is not None:
        raise ValueError(f"unsafe path in the index: {unsafe.relative_path}")
    return rows


def select_files(index: DataFrame, from_frame: float | None = None, to_frame: float | None = None, limit: int | None = None) -> DataFrame:
    """Rows whose start lies in the closed frame range, then the first `limit` of them in index order; before any image is opened."""
    out = index
    if from_frame is not None:
        out = out.filter(F.col("start_frame") >= from_frame)
    if to_frame is not None:
        out = out.filter(F.col("start_frame") <= to_frame)
    if limit is not None:
        if limit <= 0:
            raise ValueError("limit must be positive")
        order = ["pos"] if "pos" in out.columns else ["start_frame", F.lower("relative_path"), "relative_path"]
        out = out.orderBy(*order).limit(limit)
    return out


def numeric_rows(spark: SparkSession, path: str, least: int) -> DataFrame:
    """(line, v array<double>) of the lines of a text file that have at least `least` tokens, all numbers; NaN counts as one. A missing file has none."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], "line bigint, v array<double>")
    return numbers_of(spark.read.text(path).withColumn("line", F.monotonically_increasing_id()), least)


def numbers_of(lines: DataFrame, least: int) -> DataFrame:
    """(line, v) of text lines (line, value) that have at least `least` tokens, all numbers."""
    values = F.transform(F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " "), lambda t: t.try_cast("double"))
    return lines.select("line", values.alias("v")).filter((F.size("v") >= least) & F.forall("v", lambda x: x.isNotNull()))


def navigation(spark: SparkSession, set_dir: str) -> tuple[DataFrame, DataFrame]:
    """GPS rows (set_id, line, frame, lat, lon) and heading rows (set_id, line, frame, heading) of gpsdis.<set> and heading.<set>."""
    set_id = PurePosixPath(set_dir.rstrip("/")).name

    def named(rows: DataFrame, names: list[str]) -> DataFrame:
        return rows.select(F.lit(set_id).alias("set_id"), "line", *[F.get("v", F.lit(k)).alias(n) for k, n in enumerate(names)])

    return named(numeric_rows(spark, f"{set_dir}/gpsdis.{set_id}", 4), ["frame", "lat", "lon"]), named(numeric_rows(spark, f"{set_dir}/heading.{set_id}", 2), ["frame", "heading"])


def interpolated(probes: DataFrame, at: str, track: DataFrame, values: list[str], key: str = "set_id", order: str | None = "line", span: float = 65536.0) -> DataFrame:
    """probes with `values` of the track interpolated at frame column `at`; null before the first and after the last frame of the key's track.

    Of rows with one frame the first (by `order`) counts for a probe at that frame, or close to it from below, and as the end
    of a line; the last one as a line's begin. Track and probes are sorted together in spans of `span` frames, each of which
    also holds the nearest track rows of its neighbours, so a long track of one key is many tasks, and each probe gets what
    stands before and behind it in one run over its span in either direction: no pair of probe and row is built. Without a
    key column in common use a constant. A track without the order column is in order of its values. Frames of the track and
    spans are dealt to a fixed number of tasks (tasks_of), as rows that compress well would else be put into few of them.
    """
    tasks = tasks_of(probes.sparkSession)
    row = F.struct(*[F.col(v) for v in values])
    order = order if order in track.columns else row
    track = track.filter("frame IS NOT NULL AND NOT isnan(frame)").repartition(tasks, "frame")
    known = track.groupBy(key, F.col("frame").alias("__f")).agg(F.min_by(row, order).alias("first"), F.max_by(row, order).alias("last"))
    known = known.select(key, "__f", F.struct(F.col("__f").alias("frame"), "first", "last").alias("__t"))
    asked = probes.select(key, F.col(at).cast("double").alias("__f"), F.struct("*").alias("__p"))
    part = F.floor(F.col("__f") / span).alias("__s")
    marks, asked = known.select(key, part, "__f", "__t"), asked.select(key, part, "__f", "__p")
    ends = marks.groupBy(key, "__s").agg(F.min_by("__t", "__f").alias("low"), F.max_by("__t", "__f").alias("high"))
    ends = ends.unionByName(asked.select(key, "__s").distinct(), allowMissingColumns=True).groupBy(key, "__s").agg(F.first("low", True).alias("low"), F.first("high", True).alias("high"))
    outside = Window.partitionBy(key).rowsBetween(Window.unboundedPreceding, -1)
    near = ends.select(key, "__s", F.last("high", True).over(outside.orderBy("__s")).alias("before"), F.last("low", True).over(outside.orderBy(F.desc("__s"))).alias("after"))
    borders = near.select(key, "__s", F.explode(F.array(F.struct(F.lit(float("-inf")).alias("__f"), F.col("before").alias("__t")), F.struct(F.lit(float("inf")).alias("__f"), F.col("after").alias("__t")))).alias("b")).select(key, "__s", "b.*").filter("__t IS NOT NULL")
    both = marks.unionByName(borders).unionByName(asked, allowMissingColumns=True).repartition(tasks, key, "__s")
    probe = F.col("__p").isNotNull()
    here = Window.partitionBy(key, "__s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("__l", F.last("__t", True).over(here.orderBy("__f", probe))).withColumn("__h", F.last("__t", True).over(here.orderBy(F.desc("__f"), probe.desc()))).filter(probe)
    out, lf, hf, f = [F.col("__p.*")], F.col("__l.frame"), F.col("__h.frame"), F.col("__f")
    for v in values:
        begin, end = F.col(f"__l.last.{v}"), F.col(f"__h.first.{v}")
        line = begin + F.try_divide(f - lf, hf - lf) * (end - begin)
        out.append(F.when(lf == f, F.col(f"__l.first.{v}")).when(lf.isNull() | hf.isNull(), None).when(is_close(f, hf), end).otherwise(line).alias(v))
    return both.select(*out)
