"""Export of one survey set: index, checkpointed measurements, positions, CSV, GeoJSON, metadata and previews."""

from __future__ import annotations

import csv
import io
import json
import time
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict
from datetime import UTC, datetime
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transect import schemas
from transect.config import ExportConfig, output_base, safe_stem
from transect.functions.scalars import preview_name
from transect.operators.measure import aggregate_files, measure_files
from transect.operators.preview import height_image, png
from transect.plans.checkpoint import KEY, Checkpoint, fingerprint, identities
from transect.plans.files import ensure_shared_folder, exists, write_parts
from transect.plans.ordered import write_ordered
from transect.sources import survey
from transect.sources.calibration import Calibration, read_calibration
from transect.sources.records import read_image

CALIBRATION_NAME = "3D_Camera.cal"


def file_results(files: DataFrame, index: DataFrame, calibration: Calibration, config: ExportConfig, cpu=None) -> DataFrame:
    """FILE_RESULT of files (set_id, relative_path, content) in the index."""
    got = aggregate_files(measure_files(files, calibration, config.options, cpu=cpu), config.options.skip_noisy)
    named = got.join(index.select("set_id", "relative_path", "start_frame", "end_frame"), ["set_id", "relative_path"])
    return named.withColumn("file_name", F.element_at(F.split("relative_path", "/"), -1)).select(*[f.split(" ")[0] for f in schemas.FILE_RESULT.split(", ")])


def export_rows(results: DataFrame, gps: DataFrame, heading: DataFrame, min_severity: int | None = 2) -> DataFrame:
    """The exported rows: results with the positions interpolated at their start frames."""
    placed = survey.interpolated(survey.interpolated(results, "start_frame", gps, ["lat", "lon"]), "start_frame", heading, ["heading"])
    preview = F.lit(None).cast("string") if min_severity is None else F.when(F.col("severity") >= min_severity, F.concat(F.lit("previews/"), preview_name(F.col("severity"), F.col("start_frame"), F.col("file_name"))))
    names = {
        "set": "set_id", "starting_frame_number": "start_frame", "latitude": "lat", "longitude": "lon", "averaged_left_rut": "left_average", "averaged_right_rut": "right_average", "averaged_rut": "overall_average",
        "cross_slope_average_percent": "cs_percent", "cross_slope_average_angle_degrees": "cs_degrees", "cross_slope_count": "cs_count", "cross_slope_error_count": "cs_error_count",
    }
    rows = placed.withColumn("preview_png", preview)
    return rows.select(*[F.col(names.get(c, c)).alias(c) for c in schemas.EXPORT_COLUMNS])


def write_previews(files: DataFrame, calibration: Calibration, folder: str) -> DataFrame:
    """Write the preview of each of files (path, name, content) under folder on the executors; (name, size)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                body = png(height_image(calibration.apply(read_image(content.as_py(), len(calibration.offsets))["heights"])))
                write_parts(f"{folder}/{name}", [body])
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(body)], pa.int64())], names=["name", "size"])

    return files.select("name", "content").mapInArrow(work, "name string, size bigint")


def csv_line(row: dict) -> bytes:
    line = io.StringIO(newline="")
    csv.writer(line).writerow(["" if row[c] is None else row[c] for c in schemas.EXPORT_COLUMNS])
    return line.getvalue().encode()


def feature(row: dict) -> bytes:
    """A GeoJSON feature, a point if the row has a position."""
    p = {c: row[c] for c in schemas.EXPORT_COLUMNS}
    at = None if p["latitude"] is None or p["longitude"] is None else {"type": "Point", "coordinates": [p["longitude"], p["latitude"]]}
    return json.dumps({"type": "Feature", "geometry": at, "properties": p}, allow_nan=False).encode()


def diagnostic(row: dict) -> bytes:
    return f"\n    {json.dumps(row, allow_nan=False)}".encode()


def write_csv(exported: DataFrame, path: str) -> int:
    """Write exported rows as one CSV file in index order; how many."""
    return write_ordered(exported, _order(), path, csv_line, head=(",".join(schemas.EXPORT_COLUMNS) + "\r\n").encode())


def write_geojson(exported: DataFrame, path: str, name: str) -> int:
    """Write exported rows as one feature collection in index order, each feature on a line of its own, so that many tasks can read the file; how many."""
    return write_ordered(exported, _order(), path, feature, f'{{"type":"FeatureCollection","name":{json.dumps(name)},"features":[\n'.encode(), b",\n", b"\n]}\n")


def _order() -> list:
    return ["starting_frame_number", F.lower("relative_path"), "relative_path"]


def _index(spark: SparkSession, config: ExportConfig, set_id: str) -> tuple[DataFrame, str]:
    at = config.index_json or f"{config.out_dir.rstrip('/')}/set_{safe_stem(set_id)}_index.json"
    if config.rebuild_index or not exists(at):
        survey.write_index(survey.build_index(spark, config.set_dir), at)
    return survey.read_index(spark, at, set_id), at


def export_set(spark: SparkSession, config: ExportConfig, cpu=None) -> dict:
    """Run an export and return its metadata. cpu: an accumulator that gets the CPU seconds of the workers.

    Files are measured in chunks of `files_per_chunk`; each chunk that is done is in the checkpoint. A file that changes
    while it is measured ends the run before its chunk is written; one that is missing is a failed row that isn't kept.
    """
    ensure_shared_folder(spark)
    began, started = time.time(), datetime.now(UTC)
    set_dir, out = config.set_dir.rstrip("/"), config.out_dir.rstrip("/")
    set_id = PurePosixPath(set_dir).name
    if not set_id.isdigit():
        raise ValueError("the set folder must have a number as its name")
    calibration_at = config.calibration or f"{set_dir}/{CALIBRATION_NAME}"
    calibration = read_calibration(spark, calibration_at)
    raw = bytes(spark.read.format("binaryFile").load(calibration_at).first().content)
    lane = config.options.lane(calibration.pavement_width)
    base = output_base(config.output_name) if config.output_name else f"set_{safe_stem(set_id)}_average_rut_6ft_{started:%Y%m%d_%H%M%S_%f}"
    root = config.checkpoint_dir or f"{out}/.checkpoints"
    mark = fingerprint(set_id, set_dir, raw, asdict(config.options))
    everything, index_at = _index(spark, config, set_id)
    chosen = survey.select_files(everything, config.from_frame, config.to_frame, config.limit_files).withColumn("path", F.concat(F.lit(set_dir + "/"), F.col("relative_path")))
    with Checkpoint(spark, root, mark, config.resume).locked() as checkpoint:
        checkpoint.compact()
        known = chosen.join(identities(chosen), "relative_path").checkpoint()  # files are probed once
        todo = known.join(checkpoint.reusable().select(KEY), KEY, "left_anti").orderBy("pos")
        rows = todo.select("relative_path", "path", "start_frame", "end_frame", "size", "changed", "probe")
        missing = rows.filter("size < 0")
        pending = [r for r in rows.filter("size >= 0").toLocalIterator()]  # one small row for each file of a set
        reused = known.filter("size >= 0").count() - len(pending)
        for k in range(0, len(pending), config.files_per_chunk):
            part = spark.createDataFrame(pending[k : k + config.files_per_chunk], rows.schema)
            of_path = part.select("relative_path", "path", F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("p"))
            content = spark.read.format("binaryFile").load([r.path for r in pending[k : k + config.files_per_chunk]]).select(F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("p"), "content")
            files = content.join(F.broadcast(of_path), "p").select(F.lit(set_id).alias("set_id"), "relative_path", "content")
            done = file_results(files, part.withColumn("set_id", F.lit(set_id)), calibration, config, cpu)
            done = done.join(part.select("relative_path", "size", "changed", "probe"), "relative_path").checkpoint()
            changed = identities(part).join(part.select("relative_path", F.struct("size", "changed", "probe").alias("was")), "relative_path").filter(F.struct("size", "changed", "probe") != F.col("was"))
            if (other := changed.first()) is not None:
                raise RuntimeError(f"{other.relative_path} changed while it was measured")
            checkpoint.append(done.select(*[f.split(" ")[0] for f in schemas.FILE_RESULT.split(", ")], "size", "changed", "probe"), int(time.time_ns()))
        names = [f.split(" ")[0] for f in schemas.FILE_RESULT.split(", ")]
        results = checkpoint.entries().join(known.select(KEY), KEY, "left_semi").select(names)
        gone = missing.select(
            F.lit(set_id).alias("set_id"), "relative_path", F.element_at(F.split("relative_path", "/"), -1).alias("file_name"), "start_frame", "end_frame", F.lit(-1).alias("severity"), F.lit("failed").alias("status"),
            F.lit("FileNotFoundError: the file is missing").alias("file_error"), *[F.lit(0).cast("bigint").alias(c) for c in ("rows_total", "rows_ok", "rows_error", "rows_noisy", "left_count", "right_count", "cs_count", "cs_error_count")],
        )
        results = results.unionByName(gone, allowMissingColumns=True).checkpoint()
    gps, heading = survey.navigation(spark, set_dir)
    exported = export_rows(results, gps, heading, config.preview_min_severity).checkpoint()
    previews = []
    if config.preview_min_severity is not None:
        wanted = exported.filter("preview_png IS NOT NULL").select("relative_path", F.regexp_replace("preview_png", "^previews/", "").alias("name")).collect()
        if wanted:
            named = spark.createDataFrame([(f"{set_dir}/{r.relative_path}", r.name) for r in wanted], "path string, name string").withColumn("p", F.regexp_replace("path", "^[a-z0-9]+:/+", "/")).drop("path")
            content = spark.read.format("binaryFile").load([f"{set_dir}/{r.relative_path}" for r in wanted]).withColumn("p", F.regexp_replace("path", "^[a-z0-9]+:/+", "/"))
            previews = sorted(r.name for r in write_previews(content.join(F.broadcast(named), "p"), calibration, f"{out}/previews").collect())
    write_csv(exported, f"{out}/{base}.csv")
    write_geojson(exported, f"{out}/{base}.geojson", base)
    states, severities = Counter(), Counter()
    for r in results.groupBy("status", "severity").agg(F.count("*").alias("n")).collect():
        states[r.status] += r.n
        severities[str(r.severity)] += r.n
    total = sum(states.values())
    metadata = {
        "schema_version": 1, "status": "ok" if states.get("ok", 0) == total else "partial", "created_at": datetime.now(UTC).isoformat(timespec="seconds"), "elapsed_seconds": time.time() - began,
        "measurement_units": {"rut_depth": "inch", "cross_slope_average_percent": "percent", "cross_slope_average_angle_degrees": "degree"}, "set": set_id, "set_dir": set_dir, "calibration": calibration_at, "index_json": index_at,
        "options": asdict(config.options), "lane_positions_inches": {"left": lane.left, "right": lane.right, "center": lane.center}, "records_indexed": everything.count(), "records_exported": total,
        **{f"files_{s}": states.get(s, 0) for s in ("ok", "partial", "failed")}, "severity_counts": dict(severities), "previews": previews, "navigation": {"gps_rows": gps.count(), "heading_rows": heading.count()},
        "checkpoint": {"resume_requested": config.resume, "fingerprint": mark, "root": root, "records_reused": reused, "records_processed": total - reused, "records_not_checkpointed": missing.count()},
        "outputs": {"geojson": f"{out}/{base}.geojson", "csv": f"{out}/{base}.csv", "metadata_json": f"{out}/{base}.metadata.json"},
    }
    # What became of each file follows the rest in the metadata file; it grows with the set, so it isn't part of what is returned.
    head, close = json.dumps(metadata, indent=2, allow_nan=False).removesuffix("\n}"), b"\n  ]\n}\n"
    write_ordered(results, ["start_frame", "relative_path"], f"{out}/{base}.metadata.json", diagnostic, f'{head},\n  "diagnostics": ['.encode(), b",", close)
    return metadata


def inspect_file(spark: SparkSession, path: str, calibration_at: str, profile_index: int = 0, options=None) -> dict:
    """Summary of one profile of one file, measured without a crop. IndexError outside the file, ValueError if it can't be reduced or has no cross slope."""
    from transect.config import Options
    from transect.operators.measure import measure

    options = options or Options()
    calibration = read_calibration(spark, calibration_at)
    row = spark.read.format("binaryFile").load(path).select("path", "length", "content").first()
    rows = read_image(bytes(row.content), len(calibration.offsets))
    if not 0 <= profile_index < len(rows):
        raise IndexError(f"profile index must be between 0 and {len(rows) - 1}")
    raw = rows["heights"][profile_index]
    heights = calibration.apply(raw)
    got = measure(calibration.x(), heights, options.lane(calibration.pavement_width), options.reduction(), options)
    if (problem := got.get("row_error") or got.get("cs_error")) is not None:
        raise ValueError(problem)
    left, right = ((got.get(s) or {}).get("depth") for s in ("left", "right"))
    return {
        "file": path, "compressed_bytes": row.length, "profiles": len(rows), "columns": len(raw), "profile_index": profile_index, "raw_height_min": int(raw.min()), "raw_height_max": int(raw.max()),
        "calibrated_height_min_inches": float(heights.min()), "calibrated_height_max_inches": float(heights.max()), "reduced_points": got.get("n_points"), "is_noisy": got.get("is_noisy"), "cross_slope_percent": got.get("cs_percent"),
        "cross_slope_angle_degrees": got.get("cs_degrees"), "left_rut_inches": left, "right_rut_inches": right, "overall_rut_inches": None if left is None or right is None else (left + right) / 2.0,
    }
