"""The image data source, all sets in one job, and files written in order by many tasks."""

import json
import math
from collections import Counter

import pytest
import survey_files
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from transect.config import Options
from transect.functions.scalars import frame_number, frame_of
from transect.plans import sets
from transect.plans.ordered import write_ordered
from transect.plans.ranking import running_number
from transect.sources.calibration import CalibrationError, calibrations_of, parse_calibration
from transect.sources.datasource import listed, read_survey


@pytest.fixture(scope="module")
def survey(tmp_path_factory):
    """Sets 7 and 112; 7 has two files that aren't images; beside them a folder and a file that are no set's."""
    root = tmp_path_factory.mktemp("survey")
    survey_files.make_set(root, "7")
    survey_files.make_set(root, "112", frames=5, depth=900.0)
    (root / "7" / "93" / "1120134000C.3dc").write_bytes(b"xx")
    (root / "7" / "93" / "11201400C.3dc").write_bytes(b"xx")
    (root / "notes").mkdir()
    (root / "notes" / "11201410C.3dc").write_bytes(b"xx")
    (root / "11201420C.3dc").write_bytes(b"xx")
    (root / "7" / "93" / "readme.txt").write_text("no image")
    return root


def test_listing(survey):
    found = listed(str(survey))
    assert [(f.set_id, f.relative_path) for f in found] == (
        [("7", f"93/1120133{k:02d}04C.3dc") for k in range(3)] + [("7", "93/11201400C.3dc"), ("7", "93/1120134000C.3dc")] + [("112", f"93/1120133{k:02d}04C.3dc") for k in range(5)] + [(None, "notes/11201410C.3dc"), (None, "11201420C.3dc")]
    )
    assert [f.set_id for f in listed(str(survey), set_passes=lambda s: s == "112")] == ["112"] * 5
    assert listed(str(survey / "notes" / ".."))[0].path.startswith(str(survey / "notes" / ".."))


def test_frames_of_stems(spark):
    stems = ["11201330004C", "x11201330C", "99595929Z", "00600000A", "00006000A", "00000030A", "0000000A", "", "11201330C\n", "１1201330C", "112013301"]
    rows = spark.createDataFrame([(s,) for s in stems], "s string").select("s", frame_of(F.col("s")).alias("f")).collect()
    assert all(r.f == frame_number(r.s) or (r.s.endswith("\n") and frame_number(r.s) is None) for r in rows)
    with pytest.raises(ValueError):
        frame_number("x", 0)


def test_rows_and_errors(spark, survey):
    rows = read_survey(spark, str(survey)).select("set_id", "relative_path", "file_number", "row_index", F.size("raw_heights").alias("n"), F.element_at("raw_heights", 1).alias("first"), F.length("intensity").alias("i"), F.length("header").alias("h"), "error").collect()
    good = [r for r in rows if r.error is None]
    assert len(good) == 8 * 4 and all((r.n, r.i, r.h) == (1536, 1536, 8) and r.row_index in range(4) for r in good)
    assert {r["first"] for r in good} == {int(survey_files.surface(1)[0, 0]), int(survey_files.surface(1, 900.0)[0, 0])}
    bad = [r for r in rows if r.error]
    assert len(bad) == 4 and all("QuickLZError" in r.error and r.row_index is None for r in bad)
    assert {r.file_number for r in rows} == set(range(12))


def test_sets_and_frames_are_chosen_by_name(spark, survey):
    """Files that aren't asked for aren't opened: those that would be errors aren't there."""
    some = read_survey(spark, str(survey), ["7"], 1, 167434).filter("row_index = 0 OR error IS NOT NULL")
    assert sorted((r.relative_path, r.file_number, r.error) for r in some.collect()) == [(f"93/1120133{k:02d}04C.3dc", k, None) for k in range(2)]
    assert read_survey(spark, str(survey), ["112"]).filter("error IS NOT NULL").count() == 0
    assert read_survey(spark, str(survey), from_frame=1224420).select("file_number").distinct().count() == 4
    assert read_survey(spark, str(survey), []).count() == read_survey(spark, str(survey), ["none"]).count() == 0


def test_one_frame_used_twice(spark, survey):
    """Filters of one use don't reach another."""
    rows = read_survey(spark, str(survey))
    a, b = rows.filter("set_id = '7' AND error IS NULL"), rows.filter("set_id = '112'")
    assert [a.count(), b.count(), a.union(b).count(), rows.filter("set_id = '7' OR start_frame < 0").select("relative_path").distinct().count(), rows.count()] == [12, 20, 32, 5, 36]


def test_partitions_follow_bytes(spark, survey):
    one = (survey / "112" / "93" / "11201330004C.3dc").stat().st_size
    rows = read_survey(spark, str(survey), ["112"], split_bytes=2 * one)
    held = [sorted({r.file_number for r in rows.withColumn("p", F.spark_partition_id()).filter(F.col("p") == k).collect()}) for k in range(3)]
    assert held == [[0, 1], [2, 3], [4]]
    with pytest.raises(Exception, match="must be positive"):
        read_survey(spark, str(survey), split_bytes=0).count()


def test_all_sets_in_one_job(spark, survey, tmp_path):
    """File results equal those of each set's own export; a rerun over one set replaces that set only."""
    from transect.config import ExportConfig
    from transect.plans.export import export_set

    out, options = str(tmp_path / "out"), Options()
    totals = {(r.level, r.set_id, r.severity): r for r in sets.write_survey(spark, str(survey), out, options).collect()}
    files = {(r.set_id, r.relative_path): r for r in spark.read.parquet(f"{out}/files").withColumn("set_id", F.col("set_id").cast("string")).collect()}
    assert len(files) == 10 and totals["all", None, None].n == 10 and totals["set", "112", None].n_ok == 5
    for set_id in ("7", "112"):
        told = export_set(spark, ExportConfig(str(survey / set_id), str(tmp_path / set_id), output_name="x", preview_min_severity=None))
        with open(told["outputs"]["metadata_json"], encoding="utf-8") as f:
            whole = json.load(f)
        assert {k: v for k, v in whole.items() if k != "diagnostics"} == told and len(whole["diagnostics"]) == told["records_exported"]
        assert told["navigation"] == {"gps_rows": 3, "heading_rows": 3}
        for row in whole["diagnostics"]:
            mine = files.pop((set_id, row["relative_path"])).asDict()
            assert all(math.isclose(mine[k], v, rel_tol=1e-12) if isinstance(v, float) else mine[k] == v for k, v in row.items() if k != "set_id")
    assert not files
    before = sorted(map(repr, spark.read.parquet(f"{out}/files").filter("set_id = 7").collect()))
    sets.write_survey(spark, str(survey), out, Options(lane_left=20.0), ["112"])
    after = spark.read.parquet(f"{out}/files")
    assert sorted(map(repr, after.filter("set_id = 7").collect())) == before and after.count() == 10


def test_sets_without_a_usable_calibration(spark, survey, tmp_path):
    import shutil

    root = tmp_path / "s"
    shutil.copytree(survey, root)
    (root / "112" / "3D_Camera.cal").write_text("other")
    survey_files.make_set(root, "9", frames=1)
    (root / "9" / "3D_Camera.cal").write_text(survey_files.calibration().replace(" 162 ", " 2 "))
    rows = {(r.set_id, r.relative_path): r for r in sets.survey_results(spark, str(root), Options(lane_left=5.0)).collect()}
    gone = [r for (s, _), r in rows.items() if s == "112"]
    assert len(gone) == 5 and all(r.status == "failed" and r.file_error == "no usable calibration of set 112" and r.rows_total == 0 for r in gone)
    assert [(r.status, r.rows_total) for (s, _), r in rows.items() if s == "9"] == [("failed", 0)] and "lane" in next(r for (s, _), r in rows.items() if s == "9").file_error
    assert sum(r.status == "ok" for r in rows.values()) == 3


@pytest.mark.parametrize("change", [(" 2020 ", " 2020.5 "), (" 30 8 82 ", " Infinity 8 82 "), (" 30 8 82 ", " nan 8 82 "), (" 2020 1 2 ", " 2020 13 2 "), (" 162 ", " 0 "), ("3D_Camera", "2D_Camera"), (" 30 8 82 ", " x 8 82 "), ("", "")])
def test_calibrations_in_columns_refuse_what_the_parser_refuses(spark, change):
    text = survey_files.calibration(4).replace(*change, 1) if change[0] else survey_files.calibration(4)
    got = calibrations_of(spark.createDataFrame([("p", text)], "path string, value string"), 4).count()
    try:
        parse_calibration(text, 4)
        assert got == 1
    except CalibrationError:
        assert got == 0


def test_ordered_files(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.repeat(F.lit("é"), (F.col("id") % 50).cast("int")).alias("t")).repartition(7)
    want = [f"{r.k}:{r.t}".encode() for r in rows.orderBy("k").collect()]
    for between in (b"", b",\n"):
        at = str(tmp_path / f"f{len(between)}")
        for _ in range(2):  # the second time over the first file
            assert write_ordered(rows, ["k"], at, lambda r: f"{r['k']}:{r['t']}".encode(), b"[", between, b"]\n") == 5000
        assert (tmp_path / f"f{len(between)}").read_bytes() == b"[" + between.join(want) + b"]\n"
    assert write_ordered(rows.limit(0), ["k"], str(tmp_path / "none"), lambda r: b"", b"[", b",", b"]") == 0 and (tmp_path / "none").read_bytes() == b"[]"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["f0", "f2", "none"]


def test_ordered_file_that_fails_leaves_nothing(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"before")

    def broken(row):
        if row["id"] == 77:
            raise ValueError("no such row")
        return b"x"

    with pytest.raises(Exception, match="no such row"):
        write_ordered(spark.range(100), ["id"], str(tmp_path / "f"), broken)
    assert [p.name for p in tmp_path.iterdir()] == ["f"] and (tmp_path / "f").read_bytes() == b"before"


def test_ordered_files_and_running_numbers_deal_rows_out(spark, tmp_path):
    """No task holds much of an order, nor does one class; before, their tasks were those of a shuffle, and numbered ranges met in fewer still."""
    rows = spark.range(200_000).select((F.col("id") * 7919 % 200_000).alias("k"), F.when(F.col("id") % 100 == 0, F.lit("few")).alias("class"))
    got = running_number(rows, "class", ["k"], "n")
    of_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(of_task) == 200_000 and max(of_task) < 12_500
    place = F.row_number().over(Window.partitionBy("class").orderBy("k"))
    assert got.withColumn("want", place).filter("n IS NULL OR n <> want").count() == 0 and running_number(rows.limit(0), "class", ["k"], "n").count() == 0
    assert write_ordered(rows, ["k"], str(tmp_path / "f"), lambda r: b"%d %d\n" % (TaskContext.get().partitionId(), r["k"])) == 200_000
    written = [line.split() for line in (tmp_path / "f").read_bytes().splitlines()]
    assert [int(k) for _, k in written] == list(range(200_000)) and max(Counter(task for task, _ in written).values()) < 12_500
