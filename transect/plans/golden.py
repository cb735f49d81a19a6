"""Comparison with golden profiles: a JSON manifest and a NumPy archive of expected values.

The manifest must be strict JSON (no key twice, no NaN), name an archive beside it with the right SHA-256, and describe each
profile of the archive once. Profiles are laid out as rows, measured by the production operators, and compared in columns.
"""

from __future__ import annotations

import io
import json
import math
from dataclasses import asdict, dataclass
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.config import Lane, Options, Reduction
from transect.operators.measure import measure_profiles, reduce_profiles
from transect.plans.files import store, write_text

#: Fixed value of the format: the schema's name in a manifest.
SCHEMA = "pathview-oracle-golden"
#: Types of the arrays of an archive; points of a side's geometry.
ARRAYS = {
    "profile_indices": "int64", "raw_offsets": "int64", "raw_height_u16": "uint16", "calibrated_height_inches": "float64", "intensity_u8": "uint8", "reduced_offsets": "int64", "reduced_x_inches": "float64", "reduced_y_inches": "float64",
}
POINTS = ("left_reference_point", "right_reference_point", "left_contact_point", "right_contact_point", "measurement_point", "rut_point")


class GoldenError(ValueError):
    """A manifest or archive that can't be compared."""


@dataclass(frozen=True)
class Tolerances:
    reduced: float = 1e-6
    percent: float = 1e-4
    degrees: float = 1e-4
    depth: float = 1e-3
    geometry: float = 1e-2

    def __post_init__(self):
        if not all(math.isfinite(v) and v >= 0 for v in asdict(self).values()):
            raise ValueError("tolerances must be finite and not negative")


@dataclass(frozen=True)
class Golden:
    name: str
    manifest: dict
    arrays: dict[str, np.ndarray]
    pixel_width: float
    lane: Lane
    reduction: Reduction
    bar: float


def _strict(text: str) -> dict:
    def once(pairs):
        out = dict(pairs)
        if len(out) != len(pairs):
            raise GoldenError("a key of the manifest comes twice")
        return out

    def constant(name):
        raise GoldenError(f"{name} is not a JSON number")

    try:
        return json.loads(text, object_pairs_hook=once, parse_constant=constant)
    except json.JSONDecodeError as e:
        raise GoldenError(f"the manifest is no JSON: {e}") from None


def _offsets(a: np.ndarray, n: int, ends: tuple[int, ...], name: str) -> None:
    if len(a) != n + 1 or a[0] != 0 or (np.diff(a) < 0).any() or any(a[-1] != e for e in ends):
        raise GoldenError(f"{name} must rise from 0 to the size of its arrays, one step a profile")


def _check_records(records: list[dict], arrays: dict[str, np.ndarray]) -> None:
    index = arrays["profile_indices"]
    if sorted(r["npz_profile_slot"] for r in records) != list(range(len(index))) or len({r["profile_index"] for r in records}) != len(records):
        raise GoldenError("records and slots of the archive must match one to one")
    for r in records:
        slot, k = r["npz_profile_slot"], r["profile_index"]
        if int(index[slot]) != k or k < 0:
            raise GoldenError(f"profile {k} is not the one in its slot")
        for count, of in (("raw_count", "raw_offsets"), ("reduced_count", "reduced_offsets")):
            if r[count] <= 0 or r[count] != arrays[of][slot + 1] - arrays[of][slot]:
                raise GoldenError(f"profile {k}: {count} disagrees with {of}")
        x = arrays["reduced_x_inches"][arrays["reduced_offsets"][slot] : arrays["reduced_offsets"][slot + 1]]
        if (np.diff(x) <= 0).any():
            raise GoldenError(f"profile {k}: expected x must rise")
        if r["status"] != "ok":
            raise GoldenError(f"profile {k} has status {r['status']!r}")
        for side in ("left", "right"):
            if (g := r["rutting"][side]) is not None:
                [float(g["rutting_inches"]), *(float(g[p][a]) for p in POINTS for a in ("x_inches", "y_inches"))]


def load_golden(path: str) -> Golden:
    """Read and check a manifest and its archive; GoldenError for whatever is wrong with them."""
    fs, at = store(path)
    try:
        with fs.open_input_file(at) as f:
            body = _strict(f.read().decode())
        if body["schema"] != SCHEMA or body["schema_version"] != 1 or body["kind"] != "real_3dc_profiles":
            raise GoldenError("unsupported manifest")
        name = body["arrays"]["file_name"]
        if "/" in name or "\\" in name or name in ("", ".", ".."):
            raise GoldenError("the archive must lie beside the manifest")
        with fs.open_input_file(f"{at.rpartition('/')[0]}/{name}") as f:
            raw = f.read()
        if sha256(raw).hexdigest() != str(body["arrays"]["sha256"]).lower():
            raise GoldenError("the archive's SHA-256 is another")
        with np.load(io.BytesIO(raw), allow_pickle=False) as z:
            if set(z.files) != set(ARRAYS):
                raise GoldenError("the archive has other arrays than it must")
            arrays = {k: z[k] for k in ARRAYS}
        for k, t in ARRAYS.items():
            if arrays[k].ndim != 1 or arrays[k].dtype != np.dtype(t):
                raise GoldenError(f"{k} must be one-dimensional {t}")
        n = len(arrays["profile_indices"])
        if not n:
            raise GoldenError("the archive has no profile")
        _offsets(arrays["raw_offsets"], n, tuple(len(arrays[k]) for k in ("raw_height_u16", "calibrated_height_inches", "intensity_u8")), "raw_offsets")
        _offsets(arrays["reduced_offsets"], n, tuple(len(arrays[k]) for k in ("reduced_x_inches", "reduced_y_inches")), "reduced_offsets")
        if not np.isfinite(arrays["reduced_x_inches"]).all() or not np.isfinite(arrays["reduced_y_inches"]).all():
            raise GoldenError("expected coordinates must be finite")
        _check_records(body["profiles"], arrays)
        p, constants = body["parameters"], body["public_api_contract"]["rut_bar_public_constants"]
        if p["is_double_laser"] or p["dark_band_columns"]:
            raise GoldenError("double lasers and dark bands are not supported")
        lane = Lane(p["lane_left_inches"], p["lane_right_inches"], 0.0, constants["wheel_path_center_inches_from_centerline"], constants["rut_path_width_inches"])
        reduction = Reduction.survey(roll_degrees=p["roll_degrees"], max_noise=p["max_stddev_inches_high_noise"])
        width, bar = float(body["calibration"]["pixel_width"]["inches"]), float(p["rut_bar_used"]["inches"])
        if width <= 0 or bar <= 0:
            raise GoldenError("pixel width and bar length must be positive")
    except GoldenError:
        raise
    except (KeyError, TypeError, ValueError, OSError) as e:
        raise GoldenError(f"invalid golden data: {type(e).__name__}: {e}") from None
    return Golden(at.rpartition("/")[2], body, arrays, width, lane, reduction, bar)


def checks(spark: SparkSession, g: Golden, tolerances: Tolerances | None = None) -> DataFrame:
    """(profile, check, passed, max_error, rmse, tolerance), one row for each profile and check."""
    t, a = tolerances or Tolerances(), g.arrays
    rows = []
    for r in g.manifest["profiles"]:
        s = r["npz_profile_slot"]
        y = a["calibrated_height_inches"][a["raw_offsets"][s] : a["raw_offsets"][s + 1]]
        low, high = a["reduced_offsets"][s], a["reduced_offsets"][s + 1]
        wanted = {"reduced_count": float(r["reduced_count"]), "is_noisy": float(r["is_profile_noisy"]), "percent": float(r["cross_slope"]["percent"]), "degrees": float(r["cross_slope"]["angle_degrees"])}
        for side in ("left", "right"):
            side_of = r["rutting"][side]
            wanted[f"{side}_depth"] = None if side_of is None else float(side_of["rutting_inches"])
            for p in POINTS:
                for axis in "xy":
                    wanted[f"{side}_{p}_{axis}"] = None if side_of is None else float(side_of[p][f"{axis}_inches"])
        rows.append((r["profile_index"], (np.arange(len(y)) * g.pixel_width).tolist(), [None if math.isnan(v) else float(v) for v in y], a["reduced_x_inches"][low:high].tolist(), a["reduced_y_inches"][low:high].tolist(), wanted))
    table = spark.createDataFrame(rows, "profile int, x array<double>, y array<double>, ex array<double>, ey array<double>, wanted map<string,double>")
    raw = table.select(F.lit("0").alias("set_id"), F.lit("0").alias("relative_path"), F.col("profile").alias("row_index"), "x", "y")
    reduced = reduce_profiles(table.select("profile", "x", "y"), g.reduction, ["profile"]).select("profile", F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("is_noisy").alias("noisy"))
    measured = measure_profiles(raw, g.lane, g.reduction, Options(bar_length=g.bar)).select(F.col("row_index").alias("profile"), "cs_percent", "cs_degrees", "left", "right")
    both = table.drop("x", "y").join(reduced, "profile", "left").join(measured, "profile", "left")

    def array_check(name, expected, actual):
        errors = F.when(F.size(expected) == F.size(actual), F.zip_with(expected, actual, lambda e, v: F.abs(e - v)))
        most = F.array_max(errors)
        rmse = F.sqrt(F.aggregate(errors, F.lit(0.0), lambda s, e: s + e * e) / F.size(errors))
        return F.struct(F.lit(name).alias("check"), F.coalesce(most <= t.reduced, F.lit(False)).alias("passed"), most.alias("max_error"), rmse.alias("rmse"), F.lit(t.reduced).alias("tolerance"))

    def scalar_check(name, actual, tolerance):
        expected = F.col("wanted")[name]
        error = F.abs(expected - actual.cast("double"))
        passed = F.coalesce(error <= tolerance, expected.isNull() & actual.isNull())
        return F.struct(F.lit(name).alias("check"), passed.alias("passed"), error.alias("max_error"), error.alias("rmse"), F.lit(float(tolerance)).alias("tolerance"))

    each = [array_check("reduced_x", F.col("ex"), F.col("rx")), array_check("reduced_y", F.col("ey"), F.col("ry")), scalar_check("reduced_count", F.size("rx"), 0), scalar_check("is_noisy", F.col("noisy").cast("int"), 0)]
    each += [scalar_check("percent", F.col("cs_percent"), t.percent), scalar_check("degrees", F.col("cs_degrees"), t.degrees)]
    for side in ("left", "right"):
        each.append(scalar_check(f"{side}_depth", F.col(f"{side}.depth"), t.depth))
        actual = geometry(side, g.lane, g.bar)
        each += [scalar_check(f"{side}_{p}_{axis}", actual[p, axis], t.geometry) for p in POINTS for axis in "xy"]
    return both.select("profile", F.inline(F.array(*each)))


def geometry(side: str, lane: Lane, bar: float) -> dict:
    """Columns of a measured side's points, by (point, axis): the bar's ends, contacts, measurement and rut."""
    s = F.col(side)
    reach = bar / 2.0 / F.sqrt(1.0 + s["bar_slope"] * s["bar_slope"])

    def bar_y(x):
        return s["measurement_y"] + s["bar_slope"] * (x - s["measurement_x"])

    c = lane.wheel_center(side)
    low, high = c - reach, c + reach
    return {
        ("left_reference_point", "x"): low, ("left_reference_point", "y"): bar_y(low), ("right_reference_point", "x"): high, ("right_reference_point", "y"): bar_y(high),
        ("left_contact_point", "x"): s["left_contact_x"], ("left_contact_point", "y"): s["left_contact_y"], ("right_contact_point", "x"): s["right_contact_x"], ("right_contact_point", "y"): s["right_contact_y"],
        ("measurement_point", "x"): s["measurement_x"], ("measurement_point", "y"): s["measurement_y"], ("rut_point", "x"): s["rut_x"], ("rut_point", "y"): s["rut_y"],
    }


def compare(spark: SparkSession, path: str, tolerances: Tolerances | None = None, json_output: str | None = None) -> dict:
    """The report of a comparison, also written as JSON if asked for."""
    g, t = load_golden(path), tolerances or Tolerances()
    if json_output is not None and json_output.rpartition("/")[2] in (g.name, g.manifest["arrays"]["file_name"]):
        raise GoldenError("the report must not replace the golden files")
    rows = checks(spark, g, t).collect()
    profiles: dict[int, list] = {}
    for r in rows:
        profiles.setdefault(r.profile, []).append(r.asDict())
    told = [{"profile_index": k, "passed": all(c["passed"] for c in v), "failures": [c["check"] for c in v if not c["passed"]], "checks": v} for k, v in sorted(profiles.items())]
    good = sum(p["passed"] for p in told)
    report = {"schema_version": 1, "passed": good == len(told), "metadata_file": g.name, "tolerances": asdict(t), "summary": {"profiles_total": len(told), "profiles_passed": good, "profiles_failed": len(told) - good}, "profiles": told}
    if json_output is not None:
        write_text(json_output, json.dumps(report, indent=2, allow_nan=False) + "\n")
    return report


def report_text(report: dict) -> str:
    """The report for people."""
    s = report["summary"]
    lines = [f"Golden comparison: {'PASS' if report['passed'] else 'FAIL'} ({s['profiles_passed']}/{s['profiles_total']} profiles passed)"]
    for p in report["profiles"]:
        worst = {c["check"]: "n/a" if c["max_error"] is None else f"{c['max_error']:.6g}" for c in p["checks"]}
        lines.append(f"[{'PASS' if p['passed'] else 'FAIL'}] profile {p['profile_index']}: x {worst['reduced_x']}, y {worst['reduced_y']}, slope {worst['percent']} %, depths {worst['left_depth']} and {worst['right_depth']} in")
        if p["failures"]:
            lines.append("  failed: " + ", ".join(p["failures"]))
    return "\n".join(lines) + "\n"
