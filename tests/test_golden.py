import json
from hashlib import sha256

import numpy as np
import pytest
from survey_files import make_set

from transect.cli import main
from transect.config import BAR_LENGTH, ExportConfig, Lane, Reduction
from transect.operators.geometry import cross_slope, rutting
from transect.operators.reduction import reduce_profile
from transect.plans.full_run import full_run
from transect.plans.golden import GoldenError, load_golden


def point(x, y):
    return {"x_inches": x, "y_inches": y}


def side(r, c):
    if r is None:
        return None
    reach = BAR_LENGTH / 2 / np.sqrt(1 + r["bar_slope"] ** 2)
    ends = [point(x, r["measurement_y"] + r["bar_slope"] * (x - r["measurement_x"])) for x in (c - reach, c + reach)]
    names = ("left_reference_point", "right_reference_point", "left_contact_point", "right_contact_point", "measurement_point", "rut_point")
    rest = [point(r["left_contact_x"], r["left_contact_y"]), point(r["right_contact_x"], r["right_contact_y"]), point(r["measurement_x"], r["measurement_y"]), point(r["rut_x"], r["rut_y"])]
    return {"rutting_inches": r["depth"]} | dict(zip(names, [*ends, *rest], strict=True))


@pytest.fixture
def golden(tmp_path):
    """A manifest of two profiles whose expected values are our own."""
    lane, x = Lane(0.0, 162.0), np.arange(1536) * 0.10546875
    y = 2 + 0.001 * x - 0.2 * np.exp(-0.5 * ((x - 46) / 7) ** 2) - 0.3 * np.exp(-0.5 * ((x - 116) / 8) ** 2)
    records, reduced = [], []
    for k in range(2):
        p = reduce_profile(x, y * (k + 1), Reduction.survey())
        cs, (left, right) = cross_slope(p, lane), rutting(p, lane)
        reduced.append(p)
        records.append({"profile_index": 10 * k, "npz_profile_slot": k, "raw_count": 1536, "reduced_count": len(p.x), "status": "ok", "is_profile_noisy": False, "cross_slope": {"percent": cs.percent, "angle_degrees": cs.degrees}, "rutting": {"left": side(left, lane.wheel_center("left")), "right": side(right, lane.wheel_center("right"))}})
    arrays = {
        "profile_indices": np.array([0, 10]), "raw_offsets": np.array([0, 1536, 3072]), "raw_height_u16": np.zeros(3072, "u2"), "calibrated_height_inches": np.concatenate([y, 2 * y]), "intensity_u8": np.zeros(3072, "u1"),
        "reduced_offsets": np.cumsum([0, *(len(p.x) for p in reduced)]), "reduced_x_inches": np.concatenate([p.x for p in reduced]), "reduced_y_inches": np.concatenate([p.y for p in reduced]),
    }
    np.savez(tmp_path / "g.npz", **arrays)
    body = {
        "schema": "pathview-oracle-golden", "schema_version": 1, "kind": "real_3dc_profiles", "arrays": {"file_name": "g.npz", "sha256": sha256((tmp_path / "g.npz").read_bytes()).hexdigest()}, "calibration": {"pixel_width": {"inches": 0.10546875}},
        "parameters": {"is_double_laser": False, "dark_band_columns": [], "roll_degrees": 0.0, "max_stddev_inches_high_noise": 999.0, "lane_left_inches": 0.0, "lane_right_inches": 162.0, "rut_bar_used": {"inches": 72.0}},
        "public_api_contract": {"rut_bar_public_constants": {"rut_path_width_inches": 44.29134, "wheel_path_center_inches_from_centerline": 34.448819}}, "profiles": records,
    }
    (tmp_path / "g.json").write_text(json.dumps(body))
    return tmp_path, body


def test_pass_mismatch_and_corrupt(spark, golden, capsys):
    at, body = golden
    file = str(at / "g.json")
    assert main(["compare", file, "--json-output", str(at / "report.json")], spark) == 0
    assert json.loads((at / "report.json").read_text())["summary"]["profiles_passed"] == 2
    body["profiles"][1]["rutting"]["left"]["rutting_inches"] += 0.01
    (at / "g.json").write_text(json.dumps(body))
    assert main(["compare", file], spark) == 1
    assert "failed: left_depth" in capsys.readouterr().out
    assert main(["compare", file, "--depth-tolerance", "0.1"], spark) == 0
    assert main(["compare", file, "--json-output", file], spark) == 2
    (at / "g.npz").write_bytes(b"x")
    assert main(["compare", file], spark) == 2


@pytest.mark.parametrize("change", [{"schema": "other"}, {"schema_version": 2}, {"kind": "synthetic"}, {"profiles": []}, {"parameters": {}}, {"arrays": {"file_name": "../g.npz", "sha256": "0"}}])
def test_bad_manifests(golden, change):
    at, body = golden
    (at / "g.json").write_text(json.dumps(body | change))
    with pytest.raises(GoldenError):
        load_golden(str(at / "g.json"))


@pytest.mark.parametrize("text", ["{", '{"a": 1, "a": 2}', '{"a": NaN}'])
def test_strict_json(tmp_path, text):
    (tmp_path / "g.json").write_text(text)
    with pytest.raises(GoldenError):
        load_golden(str(tmp_path / "g.json"))


def test_full_run(spark, tmp_path):
    make_set(tmp_path / "in", "3", frames=2)
    make_set(tmp_path / "in", "21", frames=1)
    (tmp_path / "in" / "21" / "3D_Camera.cal").unlink()
    done = full_run(spark, str(tmp_path / "in"), str(tmp_path / "out"), ExportConfig("", ""))
    assert [(r["set_id"], r["state"]) for r in done["sets"]] == [("3", "ok"), ("21", "failed")] and not done["run"]["complete"] and done["run"]["ended"]
    assert done["sets"][0]["cpu_s"] > 0 and done["sets"][1]["cpu_s"] == 0 and 0 < done["run"]["speedup"] == pytest.approx(done["sets"][0]["cpu_s"] / sum(s["wall_s"] for s in done["sets"]))
    lines = [x.split() for x in (tmp_path / "out" / "full_run_report.txt").read_text().splitlines()]
    assert [x[:5] for x in lines[1:3]] == [["3", "ok", "2", "0", "0"], ["21", "failed", "0", "0", "0"]] and lines[3][:5] == ["all", "1", "of", "2", "ok"]
    assert (tmp_path / "out" / "set_3" / "set_3_rut_results.geojson").exists()


def test_flatten_previews(spark, tmp_path, capsys):
    old = tmp_path / "set_1" / "previews" / "high"
    old.mkdir(parents=True)
    (old / "a.png").write_bytes(b"png")
    for name in ("r.csv", "r.geojson"):
        (tmp_path / "set_1" / name).write_text('x,"previews/high/a.png"\n')
    assert main(["flatten", "--root", str(tmp_path)], spark) == 0 and (old / "a.png").exists()
    assert main(["flatten", "--root", str(tmp_path), "--apply"], spark) == 0
    assert (tmp_path / "set_1" / "previews" / "a.png").read_bytes() == b"png" and not old.exists()
    assert (tmp_path / "set_1" / "r.csv").read_text() == 'x,"previews/a.png"\n'
    old.mkdir()
    (old / "a.png").write_bytes(b"png")
    assert main(["flatten", "--root", str(tmp_path), "--apply"], spark) == 2
