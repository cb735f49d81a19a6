"""Profiles to measurements, and measurements to file results.

A file is decoded, calibrated and measured inside one Arrow function, so that only one small row for each profile leaves
it; from there on everything is columns. Errors of a profile or a file are data; programming errors still end the job.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transect import schemas
from transect.config import Lane, Options, Reduction
from transect.functions.batches import small_batches
from transect.functions.scalars import finite, severity
from transect.operators.geometry import SIDES, cross_slope, nominal_width, ruts, shoulder_slice, slope_hint, support_line, without_shoulders
from transect.operators.reduction import Profile, reduce_profile
from transect.sources.calibration import Calibration
from transect.sources.records import read_image

_SIDE = pa.struct([(f, pa.int32() if f.endswith("points") else pa.float64()) for f in schemas.SIDE_FIELDS])
_TYPES = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
_FIELDS = [(f.split(" ")[0], _SIDE if " struct" in f else _TYPES[f.split(" ")[1]]) for f in schemas.RESULT.replace(schemas.SIDE, "struct").split(", ")]


def measure_all(samples: list[tuple[np.ndarray, np.ndarray]], lane: Lane, reduction: Reduction, options: Options) -> list[dict]:
    """Rows of profiles (x, y). Cross slope and rutting share the trimmed profile; if trimming fails, each fails by itself, as both need it. Rut depths are found for all of them together."""
    rows: list[dict] = [{"state": "ok"} for _ in samples]
    able: list[tuple[dict, Profile, float]] = []
    for out, (x, y) in zip(rows, samples, strict=True):
        try:
            p = reduce_profile(x, y, reduction)
        except (ArithmeticError, ValueError) as e:
            out |= {"state": "error", "row_error": f"{type(e).__name__}: {e}"}
            continue
        out |= {"n_points": len(p.x), "is_noisy": p.is_noisy, "valid_fraction": p.valid_fraction}
        if p.is_noisy and options.skip_noisy:
            out["state"] = "skipped"
            continue
        try:
            trimmed, why = without_shoulders(p, lane), ""
        except (ArithmeticError, ValueError) as e:
            trimmed, why = None, f"{type(e).__name__}: {e}"
        if trimmed is None:
            out |= {"cs_error": why, "state": "error", "row_error": why}
            continue
        try:
            cs = cross_slope(trimmed, lane, remove_shoulders=False)
            out |= {"cs_intercept": cs.intercept, "cs_r2": cs.r2, "cs_points": cs.points}
            if not (math.isfinite(cs.percent) and math.isfinite(cs.degrees)):
                raise ArithmeticError("cross slope is not finite")
            out |= {"cs_percent": cs.percent, "cs_degrees": cs.degrees}
        except (ArithmeticError, ValueError) as e:
            out["cs_error"] = f"{type(e).__name__}: {e}"
        able.append((out, trimmed, slope_hint(p, lane)))
    try:
        both = [ruts([p for _, p, _ in able], side, lane, options.bar_length, hints=[h for *_, h in able]) for side in SIDES]
        for (out, *_), left, right in zip(able, *both, strict=True):
            out |= {"left": left, "right": right}
    except (ArithmeticError, ValueError) as e:  # of the lane and the bar, so of every profile
        for out, *_ in able:
            out |= {"state": "error", "row_error": f"{type(e).__name__}: {e}"}
    return [{k: None if isinstance(v, float) and not math.isfinite(v) else v for k, v in out.items()} for out in rows]


def measure(x: np.ndarray, y: np.ndarray, lane: Lane, reduction: Reduction, options: Options) -> dict:
    """One profile's row."""
    return measure_all([(x, y)], lane, reduction, options)[0]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in _FIELDS], names=[n for n, _ in _FIELDS])


def measure_files(files: DataFrame, calibration: Calibration, options: Options, columns: int | None = None, cpu=None) -> DataFrame:
    """RESULT rows of files (set_id, relative_path, content): one for each profile, or one with file_error for a file that can't be decoded. cpu: an accumulator that gets the CPU seconds of the workers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, reduction, x = options.lane(calibration.pavement_width), options.reduction(), calibration.x()
        for b in batches:
            for set_id, path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                name, began = {"set_id": set_id, "relative_path": path}, time.thread_time()
                try:
                    heights = calibration.apply(read_image(content.as_py(), columns or len(calibration.offsets))["heights"])
                    rows = [name | {"row_index": k} | row for k, row in enumerate(measure_all([(x, y) for y in heights], lane, reduction, options))]
                except ValueError as e:
                    rows = [name | {"state": "error", "file_error": f"{type(e).__name__}: {e}"}]
                if cpu is not None:
                    cpu.add(time.thread_time() - began)
                yield _batch(rows)

    small_batches(files.sparkSession)  # a few images at a time in a worker, however small they are compressed
    return files.select("set_id", "relative_path", "content").mapInArrow(work, schemas.RESULT)


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    """Each row's numbers, NaN for a null one; a null row has none."""
    values, ends = column.values.to_numpy(zero_copy_only=False).astype(float), column.offsets.to_numpy()
    return [values[a:z] if there else values[:0] for a, z, there in zip(ends[:-1].tolist(), ends[1:].tolist(), column.is_valid().to_pylist(), strict=True)]


def measure_profiles(profiles: DataFrame, lane: Lane | None, reduction: Reduction, options: Options | None = None) -> DataFrame:
    """RESULT rows of profiles (set_id, relative_path, row_index, x array<double>, y array<double>); a null elevation is an invalid sample.

    Without a lane each profile has that of its column pavement_width, by the options; its column error, if not null, is
    an error of its file, and so is a lane that its width doesn't allow; such rows have no row_index.
    """
    options = options or Options()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes: dict[float, Lane | str] = {}

        def lane_of(width: float | None) -> Lane | str:
            if width not in lanes:
                try:
                    lanes[width] = options.lane(width)
                except (TypeError, ValueError) as e:
                    lanes[width] = f"{type(e).__name__}: {e}"
            return lanes[width]

        for b in batches:
            rows = [dict(zip(("set_id", "relative_path", "row_index"), key, strict=True)) for key in zip(*(c.to_pylist() for c in b.columns[:3]), strict=True)]
            samples = list(zip(*(_arrays(c) for c in b.columns[3:5]), strict=True))
            among: dict[Lane, list[int]] = {} if lane is None else {lane: list(range(len(rows)))}
            if lane is None:
                for k, (width, error) in enumerate(zip(*(c.to_pylist() for c in b.columns[5:]), strict=True)):
                    where = error or lane_of(width)
                    if isinstance(where, str):
                        rows[k] |= {"row_index": None, "state": "error", "file_error": where}
                    else:
                        among.setdefault(where, []).append(k)
            for where, some in among.items():
                for k, row in zip(some, measure_all([samples[k] for k in some], where, reduction, options), strict=True):
                    rows[k] |= row
            if rows:
                yield _batch(rows)

    more = [] if lane is not None else ["pavement_width", "error"]
    return profiles.select("set_id", "relative_path", "row_index", "x", "y", *more).mapInArrow(work, schemas.RESULT)


def overall_of(left: Column, right: Column, require_both: bool = True) -> Column:
    """Mean of the two side means; with require_both null unless there are both, else the one there is."""
    both = (left + right) / 2.0
    return both if require_both else F.coalesce(both, left, right)


def aggregate_files(results: DataFrame, skip_noisy: bool = False, require_both: bool = True) -> DataFrame:
    """One row for each file of RESULT rows: side means, their mean, cross-slope means, counts, the first ten messages in row order, severity and status."""
    left, right = finite(F.col("left.depth")), finite(F.col("right.depth"))
    messages = F.filter(
        F.array(
            F.when(F.col("cs_error").isNotNull(), F.struct("row_index", F.lit(0).alias("o"), F.concat(F.lit("row "), F.col("row_index"), F.lit(" cross slope: "), F.col("cs_error")).alias("m"))),
            F.when(F.col("row_error").isNotNull(), F.struct("row_index", F.lit(1).alias("o"), F.concat(F.lit("row "), F.col("row_index"), F.lit(": "), F.col("row_error")).alias("m"))),
        ),
        lambda x: x.isNotNull(),
    )
    grouped = results.withColumn("messages", messages).groupBy("set_id", "relative_path").agg(
        F.avg(left).alias("left_average"), F.avg(right).alias("right_average"),
        F.avg(finite(F.col("cs_percent"))).alias("cs_percent"), F.avg(finite(F.col("cs_degrees"))).alias("cs_degrees"),
        F.count("row_index").alias("rows_total"), F.count_if(F.col("row_index").isNotNull() & (F.col("state") == "ok")).alias("rows_ok"),
        F.count_if(F.col("row_index").isNotNull() & (F.col("state") == "error")).alias("rows_error"), F.count_if("is_noisy").alias("rows_noisy"),
        F.count(left).alias("left_count"), F.count(right).alias("right_count"), F.count(finite(F.col("cs_percent"))).alias("cs_count"), F.count("cs_error").alias("cs_error_count"),
        F.slice(F.transform(F.array_sort(F.flatten(F.collect_list("messages"))), lambda x: x["m"]), 1, 10).alias("error_samples"), F.first("file_error", ignorenulls=True).alias("file_error"),
    )
    overall = overall_of(F.col("left_average"), F.col("right_average"), require_both)
    out = grouped.withColumn("overall_average", overall)
    whole = F.col("left_average").isNotNull() & F.col("right_average").isNotNull() & F.col("overall_average").isNotNull()
    partly = (F.col("rows_error") > 0) | (F.col("cs_error_count") > 0) | (F.lit(skip_noisy) & (F.col("rows_noisy") > 0))
    return out.withColumn("severity", severity(F.col("overall_average"))).withColumn("status", F.when(~whole, "failed").when(partly, "partial").otherwise("ok"))


def _of_profiles(profiles: DataFrame, keys: list[str], work, fields: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    """keys..., fields, error: what work(x, y) gives for each profile (x array<double>, y array<double>, null elevations invalid), as a dict; an error instead where it can't."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                try:
                    rows.append(work(np.array(x or [], float), np.array(y or [], float)))
                except (ArithmeticError, ValueError) as e:
                    rows.append({"error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r.get(n) for r in rows], t) for n, t, _ in [*fields, ("error", pa.string(), "")])], names=["k", *(f[0] for f in fields), "error"])

    few = profiles.select(F.struct(*keys).alias("k"), "x", "y")
    out = few.mapInArrow(batches_of, f"k {few.schema['k'].dataType.simpleString()}, {', '.join(f'{n} {kind}' for n, _, kind in fields)}, error string")
    return out.select("k.*", *out.columns[1:])


def reduce_profiles(profiles: DataFrame, reduction: Reduction, keys: list[str]) -> DataFrame:
    """keys..., x, y, is_noisy, noise, n_original, valid_fraction, notes, error: cleaned profiles; an error instead of arrays where too little is left."""

    def work(x: np.ndarray, y: np.ndarray) -> dict:
        p = reduce_profile(x, y, reduction)
        return {"x": p.x, "y": p.y, "is_noisy": p.is_noisy, "noise": p.noise, "n_original": p.n_original, "valid_fraction": p.valid_fraction, "notes": list(p.notes)}

    number = pa.list_(pa.float64())
    kinds = [("x", number, "array<double>"), ("y", number, "array<double>"), ("is_noisy", pa.bool_(), "boolean"), ("noise", pa.float64(), "double"), ("n_original", pa.int32(), "int"), ("valid_fraction", pa.float64(), "double"), ("notes", pa.list_(pa.string()), "array<string>")]
    return _of_profiles(profiles, keys, work, kinds)


def profile_parts(profiles: DataFrame, lane: Lane, reduction: Reduction, keys: list[str]) -> DataFrame:
    """keys..., start, stop, width, hint, left_slope, left_height, right_slope, right_height, error: the part between the shoulders (numbers of samples, stop exclusive), the nominal width, the slope hint, and the line on top of each half of the lane, lowest at its wheel centre (null where it isn't carried)."""

    def work(x: np.ndarray, y: np.ndarray) -> dict:
        p = reduce_profile(x, y, reduction)
        start, stop = shoulder_slice(p, lane)
        out = {"start": start, "stop": stop, "width": nominal_width(p), "hint": slope_hint(p, lane)}
        for side in SIDES:
            (low, high), c = lane.half(side), lane.wheel_center(side)
            inside = (p.x >= low) & (p.x <= high)
            if inside.sum() > 1 and p.x[inside][0] <= c <= p.x[inside][-1]:
                out[f"{side}_slope"], out[f"{side}_height"], *_ = support_line(p.x[inside], p.y[inside], c, out["hint"])
        return out

    names = ("width", "hint", *(f"{side}_{what}" for side in SIDES for what in ("slope", "height")))
    return _of_profiles(profiles, keys, work, [("start", pa.int32(), "int"), ("stop", pa.int32(), "int"), *((n, pa.float64(), "double") for n in names)])
