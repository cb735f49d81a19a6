"""Operators in columns against plain versions, and the checkpoint's lock and compaction."""

import math

import numpy as np
import pytest
import survey_files
from pyspark.sql import functions as F
from test_kernels import two_dips

from transect import schemas
from transect.cli import main
from transect.config import Lane
from transect.operators import hulls
from transect.operators.geometry import rut, slope_hint, support_line
from transect.operators.reduction import Profile, residual_noise
from transect.plans.checkpoint import Checkpoint, probe, probe_of

LANE = Lane(0.0, 162.0, 0.5)


def shapes():
    rng = np.random.default_rng(4)
    x = np.arange(300) * 162.0 / 300
    smooth = np.cumsum(rng.normal(0, 0.02, 300))
    return {
        "random": (x, rng.normal(0, 0.3, 300)), "smooth": (x, smooth), "flat": (x, np.zeros(300)), "line": (x, 0.01 * x), "roof": (x, -np.abs(x - 81.0) * 0.01), "bowl": (x, np.abs(x - 81.0) * 0.01),
        "dips": (x, -sum(np.exp(-0.5 * ((x - c) / 6.0) ** 2) for c in (46.55, 115.45))), "short": (x[:40], smooth[:40]), "two": (np.array([10.0, 150.0]), np.array([1.0, 2.0])), "one": (np.array([46.0]), np.array([1.0])), "steps": (x, np.floor(x / 10) % 2 * 0.5),
        "uneven": (np.sort(rng.choice(np.arange(1620) / 10.0, 200, replace=False)), rng.normal(0, 0.1, 200)),
    }


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(n, x.tolist(), y.tolist()) for n, (x, y) in shapes().items()], "name string, x array<double>, y array<double>").cache()


def brute_hull(x, y):
    """Samples that no chord of two others passes at or above (by more than rounding)."""
    out = []
    for k in range(len(x)):
        left = min(((y[k] - y[i]) / (x[k] - x[i]) for i in range(k)), default=math.inf)
        right = max(((y[i] - y[k]) / (x[i] - x[k]) for i in range(k + 1, len(x))), default=-math.inf)
        if left > right + 1e-12 * max(1.0, abs(right) if math.isfinite(right) else 1.0):
            out.append((x[k], y[k]))
    return out


def test_hull_vertices(spark, rows):
    got = {r.name: [(p.x, p.y) for p in r.h] for r in rows.select("name", hulls.upper_hull(hulls.pairs(F.col("x"), F.col("y"))).alias("h")).collect()}
    for name, (x, y) in shapes().items():
        assert got[name] == brute_hull(x, y), name
    empty = spark.createDataFrame([([], [])], "x array<double>, y array<double>").select(hulls.upper_hull(hulls.pairs(F.col("x"), F.col("y"))).alias("h")).first()
    assert empty.h == []


@pytest.mark.parametrize("c", [46.0, 81.0, 54.0, 10.0, 150.0, 162.0])
def test_supporting_line(rows, c):
    got = {r.name: r.line for r in rows.select("name", hulls.supporting_line(hulls.upper_hull(hulls.pairs(F.col("x"), F.col("y"))), c, 0.003).alias("line")).collect()}
    for name, (x, y) in shapes().items():
        if len(x) < 2 or not x[0] <= c <= x[-1]:
            assert got[name] is None
            continue
        slope, height, left, right = support_line(x, y, c, 0.003)
        assert got[name].slope == pytest.approx(slope, abs=1e-9) and got[name].height == pytest.approx(height, abs=1e-9), name
        assert (got[name].left_x, got[name].right_x) == (x[left], x[right]), name


@pytest.mark.parametrize("side", ["left", "right"])
def test_rut_depth(rows, side):
    hints = {n: slope_hint(Profile(x, y), LANE) for n, (x, y) in shapes().items()}
    hint = F.coalesce(*[F.when(F.col("name") == n, float(h)) for n, h in hints.items()])
    got = {r.name: r.rut for r in rows.select("name", hulls.rut(F.col("x"), F.col("y"), hint, LANE, side).alias("rut")).collect()}
    some = 0
    for name, (x, y) in shapes().items():
        want = rut(Profile(x, y), side, LANE, hint=hints[name])
        if want is None:
            assert got[name] is None, name
            continue
        some += 1
        for field, other in (("depth", "depth"), ("rut_x", "rut_x"), ("rut_y", "rut_y"), ("bar_slope", "bar_slope"), ("left_x", "left_contact_x"), ("right_x", "right_contact_x")):
            assert got[name][field] == pytest.approx(want[other], abs=1e-7), (name, field)
        assert (got[name].supports, got[name].footprint_points) == (want["support_points"], want["footprint_points"]), name
    assert some >= 8


@pytest.mark.parametrize(("more", "at"), [(0.0, 15), (3e-10, 15), (-3e-10, 15), (3e-8, 45)])
def test_depths_equal_to_nine_places_are_equal(spark, more, at):
    x, y = two_dips(more)
    points = hulls.pairs(F.lit(x.tolist()), F.lit(y.tolist()))
    line = F.struct(F.lit(0.0).alias("slope"), F.lit(0.0).alias("height"))
    got = spark.range(1).select(hulls.deepest_footprint(points, F.lit(2.0), F.lit(58.0), line, 30.0).alias("d")).first().d
    assert got.at == pytest.approx(at, abs=1e-6) and got.most == pytest.approx(0.2 + max(more, 0) * 2 / 3, abs=1e-14)


@pytest.mark.parametrize("window", [0.1, 5.0, 20.0, 500.0])
def test_residual_noise(rows, window):
    got = {r.name: r.noise for r in rows.select("name", hulls.residual_noise(F.col("x"), F.col("y"), window).alias("noise")).collect()}
    for name, (x, y) in shapes().items():
        assert got[name] == pytest.approx(residual_noise(x, y, window), abs=1e-9), name


def test_probes_as_an_expression(spark):
    rng = np.random.default_rng(8)
    bodies = [rng.bytes(n) for n in (0, 1, 4095, 4096, 4097, 4098, 8192, 12_289, 100_000)]
    got = spark.createDataFrame([(k, bytearray(b)) for k, b in enumerate(bodies)], "k int, b binary").select("k", probe_of(F.col("b")).alias("p")).collect()
    assert all(r.p == probe(lambda at, n, b=bodies[r.k]: b[at : at + n], len(bodies[r.k])) for r in got)


def entry(spark, path, status="ok"):
    names = [f.split(" ")[:2] for f in schemas.FILE_RESULT.split(", ")]
    known = {"relative_path": F.lit(path), "status": F.lit(status), "start_frame": F.lit(1.0), "end_frame": F.lit(2.0)}
    return spark.range(1).select(*[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in names], F.lit(9).cast("bigint").alias("size"), F.lit(9).cast("bigint").alias("changed"), F.lit("p").alias("probe"))


def test_a_second_run_spoils_nothing(spark, tmp_path):
    """A run without resume that can't get the lock leaves the results of the one that has it; a lock that isn't its own stays."""
    first = Checkpoint(spark, str(tmp_path), "x")
    lock = tmp_path / "fingerprint=x.lock"
    with first.locked():
        first.append(entry(spark, "a"), 1)
        with pytest.raises(RuntimeError, match="another run holds"), Checkpoint(spark, str(tmp_path), "x", resume=False).locked():
            pass
        assert first.entries().count() == 1 and lock.exists()
        (tmp_path / ".fingerprint=x.lock.crc").unlink()
        lock.write_text("someone else's")
    assert lock.read_text() == "someone else's"
    lock.unlink()
    with Checkpoint(spark, str(tmp_path), "x", resume=False).locked() as again:
        assert again.entries().count() == 0
    assert not lock.exists()


def test_compaction(spark, tmp_path):
    done = Checkpoint(spark, str(tmp_path), "x")
    with done.locked():
        assert not done.compact(2)
        for k in range(6):
            done.append(entry(spark, f"f{k % 3}", "failed" if k < 3 else "ok"), k)
        before = sorted(map(repr, done.entries().collect()))
        assert done.compact(2) and not done.compact(2)
        assert sorted(map(repr, done.entries().collect())) == before and len(before) == 3 and done.reusable().count() == 3
        assert len(list((tmp_path / "fingerprint=x").glob("*.parquet"))) <= 2
    # A compaction that died after the table was moved away, and one that died before.
    (tmp_path / "fingerprint=x").rename(tmp_path / "fingerprint=x.merged")
    with done.locked():
        assert done.entries().count() == 3
        (tmp_path / "fingerprint=x.merged").mkdir()
    with done.locked():
        assert done.entries().count() == 3 and not (tmp_path / "fingerprint=x.merged").exists()


def test_survey_command(spark, tmp_path, capsys):
    for set_id in ("7", "112"):
        survey_files.make_set(tmp_path / "in", set_id, frames=1, depth=900.0)
    assert main(["survey", "--data-root", str(tmp_path / "in"), "--out-dir", str(tmp_path / "out")], spark) == 0
    assert '"files": 2, "files_ok": 2' in capsys.readouterr().out
    assert {p.name for p in (tmp_path / "out" / "files").glob("set_id=*")} == {"set_id=7", "set_id=112"}
