import csv
import json

import numpy as np
import pytest
from survey_files import calibration, image, make_set, surface

from transect import schemas
from transect.cli import main
from transect.config import ExportConfig, Options, output_base
from transect.plans.batch import run_batch
from transect.plans.checkpoint import fingerprint
from transect.plans.export import export_set, inspect_file, write_geojson
from transect.plans.maps import build_map, features
from transect.sources import survey
from transect.sources.calibration import parse_calibration
from transect.streaming.incremental import measure_stream


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    at = tmp_path_factory.mktemp("survey")
    make_set(at, "112", depth=300.0)
    make_set(at, "7", frames=2, depth=150.0)
    (at / "notes").mkdir()
    return at


@pytest.fixture(scope="module")
def exported(spark, root, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    config = ExportConfig(str(root / "112"), str(out), output_name="set_112_rut_results")
    return out, config, export_set(spark, config)


def test_export_writes_rows_in_order(exported):
    out, _, meta = exported
    rows = list(csv.DictReader((out / "set_112_rut_results.csv").open()))
    assert len(rows) == 3 and meta["records_exported"] == 3 and meta["status"] == "ok"
    assert [float(r["starting_frame_number"]) for r in rows] == sorted(float(r["starting_frame_number"]) for r in rows)
    first = rows[0]
    frame = float(first["starting_frame_number"])
    assert float(first["longitude"]) == pytest.approx(-78 - (frame - 167400) / 10)
    assert float(first["averaged_rut"]) == pytest.approx((float(first["averaged_left_rut"]) + float(first["averaged_right_rut"])) / 2)
    assert int(first["severity"]) >= 2 and first["preview_png"].startswith("previews/")
    body = json.loads((out / "set_112_rut_results.geojson").read_text())
    assert [f["properties"]["file_name"] for f in body["features"]] == [r["file_name"] for r in rows]
    assert (out / first["preview_png"]).read_bytes().startswith(b"\x89PNG")


def test_second_run_reuses_results(spark, exported):
    _, config, _ = exported
    assert export_set(spark, config)["checkpoint"]["records_reused"] == 3


def test_changed_file_is_measured_again(spark, tmp_path):
    folder = make_set(tmp_path, "9")
    config = ExportConfig(str(folder), str(tmp_path / "out"), output_name="r", preview_min_severity=None)
    export_set(spark, config)
    name = next((folder / "93").iterdir())
    name.write_bytes(image(surface(4, 10.0)))
    done = export_set(spark, config)
    assert done["checkpoint"]["records_reused"] == 2 and done["previews"] == []


def test_bad_file_is_a_failed_row_and_tried_again(spark, tmp_path):
    folder = make_set(tmp_path, "9", frames=2)
    (folder / "93" / "112013355" "04C.3dc").write_bytes(b"\x46\x00")
    config = ExportConfig(str(folder), str(tmp_path / "out"), output_name="r")
    done = export_set(spark, config)
    assert (done["status"], done["files_failed"], done["files_ok"]) == ("partial", 1, 2)
    assert export_set(spark, config)["checkpoint"]["records_reused"] == 2


def test_batch_and_map(spark, root, tmp_path):
    done = run_batch(spark, str(root), ExportConfig("", str(tmp_path), output_name=None))
    assert [r["set"] for r in done["results"]] == ["7", "112"] and done["sets_ok"] == 2 and done["records_exported"] == 5
    for r in done["results"]:
        folder = tmp_path / f"set_{r['set']}"
        next(folder.glob("*_average_rut_6ft_*.geojson")).rename(folder / f"set_{r['set']}_rut_results.geojson")
    manifest = build_map(spark, str(tmp_path), str(tmp_path / "map"))
    assert manifest["mapped"] == 5 and (tmp_path / "map" / "map.html").exists()
    assert len(json.loads((tmp_path / "map" / "display.geojson").read_text())["features"]) == sum(manifest["display_counts"].values())


def test_sets(spark, root):
    assert survey.discover_sets(spark, str(root)) == ["7", "112"]
    for wanted in (["7", "7"], ["8"]):
        with pytest.raises(ValueError):
            survey.discover_sets(spark, str(root), wanted)


def test_inspect_and_cli(spark, root, tmp_path, capsys):
    file, cal = str(next((root / "112" / "93").iterdir())), str(root / "112" / "3D_Camera.cal")
    got = inspect_file(spark, file, cal, 1)
    assert got["profiles"] == 4 and got["overall_rut_inches"] == pytest.approx((got["left_rut_inches"] + got["right_rut_inches"]) / 2)
    assert main(["inspect-file", file, "--calibration", cal, "--json"], spark) == 0
    assert json.loads(capsys.readouterr().out)["columns"] == 1536
    assert main(["inspect-file", file, "--calibration", cal, "--profile-index", "9"], spark) == 2
    assert main(["export-set", "--data-root", str(root), "--set", "7x", "--out-dir", str(tmp_path)], spark) == 2
    assert main(["export-set", "--set-dir", str(root / "7"), "--out-dir", str(tmp_path), "--no-previews", "--limit-files", "1"], spark) == 0
    with pytest.raises(SystemExit):
        main(["export-set"], spark)


def test_stream_measures_each_file_once(spark, root, tmp_path):
    cal = parse_calibration(calibration())
    for _ in range(2):
        measure_stream(spark, str(root), cal, Options(), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted((r.set_id, r.rows_total) for r in rows) == [("112", 4)] * 3 + [("7", 4)] * 2


def test_index_json(spark, root, tmp_path):
    built = survey.build_index(spark, str(root / "112"))
    survey.write_index(built, str(tmp_path / "i.json"))
    rows = survey.read_index(spark, str(tmp_path / "i.json"), "112").orderBy("pos").collect()
    assert [r.relative_path for r in rows] == [f"93/1120133{k:02d}04C.3dc" for k in range(3)]
    assert rows[0].end_frame == rows[1].start_frame and rows[2].end_frame - rows[2].start_frame == rows[1].end_frame - rows[1].start_frame
    body = json.loads((tmp_path / "i.json").read_text())
    for change in ({"schema_version": 2}, {"set": "7"}, {"records": []}, {"records": [{"relative_path": "../x", "start_frame": 1, "end_frame": 2}]}):
        (tmp_path / "b.json").write_text(json.dumps(body | change))
        with pytest.raises(ValueError):
            survey.read_index(spark, str(tmp_path / "b.json"), "112")


def test_fingerprint_follows_calibration_options_and_source():
    base = fingerprint("1", "/a/1", b"cal", {"x": 1})
    assert base == fingerprint("1", "/a/1/", b"cal", {"x": 1})
    assert len({base, fingerprint("1", "/b/1", b"cal", {"x": 1}), fingerprint("1", "/a/1", b"other", {"x": 1}), fingerprint("1", "/a/1", b"cal", {"x": 2})}) == 4


def test_names():
    assert output_base("run.geojson") == "run"
    for bad in ("", "a/b", "..", "CON", "a b", "a\\b"):
        with pytest.raises(ValueError):
            output_base(bad)
    assert np.isfinite(parse_calibration(calibration()).resolution)


def test_a_large_export_is_read_by_many_tasks(spark, tmp_path):
    names = {"set": "'7'", "file_name": "concat('a,\"]}', id)", "relative_path": "concat('d/', id)", "severity": "CAST(id % 4 AS INT)", "preview_png": "CAST(NULL AS STRING)", "latitude": "IF(id % 5 = 0, NULL, id / 2)", "cross_slope_count": "id", "cross_slope_error_count": "id"}
    rows = spark.range(600).selectExpr(*[f"{names.get(c, 'CAST(id AS DOUBLE)')} AS `{c}`" for c in schemas.EXPORT_COLUMNS])
    assert write_geojson(rows, str(tmp_path / "own.geojson"), "n\n]}") == 600 and write_geojson(rows.limit(0), str(tmp_path / "none.geojson"), "n") == 0
    body = json.loads((tmp_path / "own.geojson").read_text())
    assert len(body["features"]) == 600 and json.loads((tmp_path / "none.geojson").read_text())["features"] == []
    (tmp_path / "b c.geojson").write_text(json.dumps(body, indent=2))
    (tmp_path / "line.geojson").write_text(json.dumps(body, separators=(",", ":")))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        own = features(spark, str(tmp_path / "own.geojson"))
        assert own.rdd.getNumPartitions() > 4
        alone, together = own.collect(), features(spark, str(tmp_path / "*.geojson")).collect()
        assert features(spark, str(tmp_path / "*.geojson")).filter("lon IS NOT NULL").count() == 3 * 480
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert [(r.pos, r.relative_path, r.lat, r.lon) for r in sorted(alone)] == [(k, f"d/{k}", None if k % 5 == 0 else k / 2, None if k % 5 == 0 else k) for k in range(600)]
    assert sorted(together, key=str) == sorted(alone * 3, key=str)
