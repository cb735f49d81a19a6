"""Command line: inspect-file, export-set, batch, full-run, survey, map, compare, flatten. Exit 0 if all is well, 1 if some files or sets aren't, 2 for an error."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from transect.config import BAR_LENGTH, POLICIES, ExportConfig, Options
from transect.plans.golden import Tolerances


#: Options of processing that are numbers, with their defaults.
NUMBERS = {"lane-left-inches": 0.0, "lane-right-inches": None, "lane-center-offset-inches": 0.0, "rut-bar-inches": BAR_LENGTH, "roll-degrees": 0.0, "minimum-valid-fraction": 0.5, "max-interpolation-gap-inches": None, "max-noise-std-inches": None}


def _options(to: argparse.ArgumentParser) -> None:
    for name, value in NUMBERS.items():
        to.add_argument(f"--{name}", type=float, default=value)
    to.add_argument("--invalid-policy", default=POLICIES[0], choices=POLICIES)
    to.add_argument("--skip-noisy-profiles", action="store_true")


def _run_options(to: argparse.ArgumentParser) -> None:
    _options(to)
    to.add_argument("--out-dir", required=True)
    to.add_argument("--limit-files", type=int)
    to.add_argument("--checkpoint-dir")
    to.add_argument("--checkpoint-every", metavar="FILES", default=4096, type=int)
    to.add_argument("--no-resume", dest="resume", action="store_false")
    either = to.add_mutually_exclusive_group()
    either.add_argument("--preview-min-severity", choices=(2, 3), default=2, type=int)
    either.add_argument("--no-previews", dest="preview_min_severity", action="store_const", const=None)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="transect", description="Transverse profiles: decoding, cross slope and rut depth.")
    commands = out.add_subparsers(dest="command", required=True)
    new = {name: commands.add_parser(name) for name in ("inspect-file", "export-set", "batch", "full-run", "survey", "map", "compare", "flatten")}

    def texts(command: str, *names: str, required: bool = False) -> None:
        for n in names:
            new[command].add_argument(f"--{n}", required=required)

    new["inspect-file"].add_argument("file")
    texts("inspect-file", "calibration", required=True)
    new["inspect-file"].add_argument("--profile-index", default=0, type=int)
    new["inspect-file"].add_argument("--json", action="store_true")
    _options(new["inspect-file"])
    where = new["export-set"].add_mutually_exclusive_group(required=True)
    where.add_argument("--set-dir")
    where.add_argument("--data-root")
    texts("export-set", "set", "calibration", "index-json", "output-name")
    for edge in ("from", "to"):
        new["export-set"].add_argument(f"--{edge}-frame", type=float)
    new["export-set"].add_argument("--rebuild-index", action="store_true")
    texts("batch", "data-root", required=True)
    texts("batch", "index-dir")
    new["batch"].add_argument("--rebuild-indexes", action="store_true")
    texts("full-run", "data-root", required=True)
    texts("survey", "data-root", "out-dir", required=True)
    _options(new["survey"])
    for command in ("batch", "full-run", "survey"):
        new[command].add_argument("--sets", nargs="+")
    for command in ("export-set", "batch", "full-run"):
        _run_options(new[command])
    texts("map", "root", "out-dir", required=True)
    texts("flatten", "root", required=True)
    new["flatten"].add_argument("--apply", action="store_true")
    new["compare"].add_argument("metadata_json")
    texts("compare", "json-output")
    for name, value in asdict(Tolerances()).items():
        new["compare"].add_argument(f"--{name}-tolerance", default=value, type=float)
    return out


def _options_of(a: argparse.Namespace) -> Options:
    noise = 999.0 if a.max_noise_std_inches is None else a.max_noise_std_inches
    return Options(
        lane_left=a.lane_left_inches, lane_right=a.lane_right_inches, lane_center_offset=a.lane_center_offset_inches, bar_length=a.rut_bar_inches, roll_degrees=a.roll_degrees,
        invalid_policy=a.invalid_policy, min_valid_fraction=a.minimum_valid_fraction, max_gap=a.max_interpolation_gap_inches, max_noise=noise, skip_noisy=a.skip_noisy_profiles,
    )


def _run(a: argparse.Namespace, spark: SparkSession) -> int:
    from transect.plans.batch import run_batch
    from transect.plans.export import export_set, inspect_file
    from transect.plans.maps import build_map

    if a.command == "inspect-file":
        print(json.dumps(inspect_file(spark, a.file, a.calibration, a.profile_index, _options_of(a)), indent=None if a.json else 2, allow_nan=False))
        return 0
    if a.command == "compare":
        from transect.plans.golden import compare, report_text

        t = Tolerances(a.reduced_tolerance, a.percent_tolerance, a.degrees_tolerance, a.depth_tolerance, a.geometry_tolerance)
        report = compare(spark, a.metadata_json, t, a.json_output)
        print(report_text(report), end="")
        return int(not report["passed"])
    if a.command == "flatten":
        from transect.plans.flatten import flatten_previews

        print(json.dumps(flatten_previews(a.root, a.apply)))
        return 0
    if a.command == "survey":
        from transect.plans.sets import write_survey

        totals = write_survey(spark, a.data_root, a.out_dir, _options_of(a), a.sets).filter("level = 'all'").first()
        print(json.dumps({"files": totals.n, "files_ok": totals.n_ok, "average_rut": totals.depth}))
        return int(totals.n != totals.n_ok)
    if a.command == "map":
        print(json.dumps(build_map(spark, a.root, a.out_dir), indent=2))
        return 0
    shared = {"out_dir": a.out_dir, "limit_files": a.limit_files, "resume": a.resume, "checkpoint_dir": a.checkpoint_dir, "files_per_chunk": a.checkpoint_every, "preview_min_severity": a.preview_min_severity, "options": _options_of(a)}
    if a.command == "full-run":
        from transect.plans.full_run import full_run

        done = full_run(spark, a.data_root, a.out_dir, ExportConfig(set_dir="", **shared), a.sets)
        return int(not done["run"]["complete"])
    if a.command == "batch":
        done = run_batch(spark, a.data_root, ExportConfig(set_dir="", rebuild_index=a.rebuild_indexes, **shared), a.sets, a.index_dir)
        print(json.dumps(done, indent=2, allow_nan=False))
        return int(done["sets_failed"] > 0)
    set_dir = a.set_dir
    if set_dir is None:
        if not a.set or not a.set.isdigit():
            raise ValueError("--data-root takes --set with a number")
        set_dir = f"{a.data_root.rstrip('/')}/{a.set}"
    elif a.set:
        raise ValueError("--set goes with --data-root only")
    config = ExportConfig(set_dir=set_dir, calibration=a.calibration, index_json=a.index_json, rebuild_index=a.rebuild_index, from_frame=a.from_frame, to_frame=a.to_frame, output_name=a.output_name, **shared)
    done = export_set(spark, config)
    print(json.dumps({k: v for k, v in done.items() if k != "diagnostics"}, indent=2, allow_nan=False))
    return int(done["status"] != "ok")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command; argparse's own exits stay as they are."""
    args = parser().parse_args(argv)
    try:
        return _run(args, spark or SparkSession.builder.appName("transect").getOrCreate())
    except (OSError, ValueError, RuntimeError, IndexError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
