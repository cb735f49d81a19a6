import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from transect.sources import survey
from transect.sources.calibration import CalibrationError, parse_calibration
from transect.sources.quicklz import QuickLZError, decompress, parse_header
from transect.sources.records import decode_records
from transect.sources.survey import interpolated, numeric_rows

BODY = bytes.fromhex("08000080") + b"abc" + bytes.fromhex("7745") + b"WXYZ"
BLOCK = b"\x47" + (len(BODY) + 9).to_bytes(4, "little") + (16).to_bytes(4, "little") + BODY


def compress(data: bytes) -> bytes:
    """A plain level-1 coder for tests: greedy matches through the same table of positions."""
    out, literals, slots, hashed, d = bytearray(), 0, [0] * 4096, 0, 0
    control_at, control, bits = 0, 0, 0
    out += b"\0\0\0\0"
    last = len(data) - 11

    def hash_until(end):
        nonlocal hashed
        while hashed < end:
            f = int.from_bytes(data[hashed : hashed + 3], "little")
            slots[(f >> 12 ^ f) & 4095] = hashed
            hashed += 1

    def bit(value):
        nonlocal control_at, control, bits
        if bits == 31:
            out[control_at : control_at + 4] = (control | 1 << 31).to_bytes(4, "little")
            control_at, control, bits = len(out), 0, 0
            out.extend(b"\0\0\0\0")
        control |= value << bits
        bits += 1

    while d <= last:
        f = int.from_bytes(data[d : d + 3], "little")
        slot = (f >> 12 ^ f) & 4095
        at = slots[slot]
        n = 0
        while at <= d - 3 and d + n < last and n < 255 and data[at + n] == data[d + n]:
            n += 1
        if n >= 3:
            bit(1)
            low = slot << 4
            out += (low | n - 2).to_bytes(2, "little") if n <= 17 else low.to_bytes(2, "little") + bytes([n])
            start, d = d, d + n
            hash_until(start + 1)
            hashed = d
        else:
            bit(0)
            out.append(data[d])
            d += 1
            hash_until(d - 2)
    while d < len(data):
        bit(0)
        out.append(data[d])
        d += 1
    out[control_at : control_at + 4] = (control | 1 << 31 if bits == 31 else control | 1 << bits if bits < 31 else control).to_bytes(4, "little")
    return b"\x47" + (len(out) + 9).to_bytes(4, "little") + len(data).to_bytes(4, "little") + bytes(out)


def test_quicklz_blocks():
    assert decompress(BLOCK) == b"abcabcabcabcWXYZ"
    assert decompress(b"\x46" + (12).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"xyz") == b"xyz"
    assert decompress(b"\x44\x06\x03xyz") == b"xyz"
    h = parse_header(BLOCK)
    assert (h.size, h.compressed, h.decompressed, h.level, h.streaming, h.is_compressed) == (9, 22, 16, 1, 0, True)


def test_quicklz_round_trip():
    rng = np.random.default_rng(3)
    for n in (12, 30, 200, 5000):
        for alphabet in (2, 5, 250):
            data = bytes(rng.integers(0, alphabet, n, dtype=np.uint8)) + b"tail of it all"
            assert decompress(compress(data)) == data


@pytest.mark.parametrize("block", [b"", b"\x46\x00", BLOCK[:-1], b"\x4e" + BLOCK[1:], b"\x57" + BLOCK[1:], b"\x44\x05\x03xy", b"\x47" + (13).to_bytes(4, "little") + (16).to_bytes(4, "little") + b"\0\0\0\0", b"\x47" + (9).to_bytes(4, "little") + (0).to_bytes(4, "little")])
def test_quicklz_rejects(block):
    with pytest.raises(QuickLZError):
        decompress(block)


def test_quicklz_limit_and_damage():
    with pytest.raises(QuickLZError):
        decompress(BLOCK, max_output=15)
    with pytest.raises(ValueError):
        decompress(BLOCK, max_output=0)
    rng = np.random.default_rng(4)
    good = compress(bytes(rng.integers(0, 4, 300, dtype=np.uint8)))
    for _ in range(300):  # damaged blocks give bytes or QuickLZError, nothing else
        bad = bytearray(good)
        bad[int(rng.integers(9, len(bad)))] ^= int(rng.integers(1, 256))
        try:
            assert len(decompress(bytes(bad))) == 300
        except QuickLZError:
            pass


def test_records():
    rows = np.zeros(2, np.dtype([("h", "V8"), ("i", "u1", (4,)), ("y", "<u2", (4,))]))
    rows["i"] = [[1, 2, 3, 4], [10, 20, 30, 40]]
    rows["y"] = [[100, 200, 300, 400], [11, 22, 33, 44]]
    got = decode_records(rows.tobytes(), 4)
    assert got["heights"].tolist() == [[400, 300, 200, 100], [44, 33, 22, 11]] and got["intensity"][0].tolist() == [4, 3, 2, 1]
    assert decode_records(rows.tobytes(), 4, reverse=False)["heights"][0].tolist() == [100, 200, 300, 400]
    for args in ((b"", 4), (rows.tobytes()[:-1], 4), (rows.tobytes(), 0), (rows.tobytes(), 4, True, 3)):
        with pytest.raises(ValueError):
            decode_records(*args)


TEXT = "3D_Camera_Calibration -1.5 0 2.5 10 3 1 4 40 0.03 0.03 4 0.125 2020 2 29 14 57 772 3.1"


def test_calibration():
    c = parse_calibration("﻿" + TEXT, 4)
    assert (c.pixel_width, c.resolution, c.extra) == (10.0, 0.78125, (772.0, 3.1))
    assert c.apply(np.array([[0, 0, 10, 10]], "u2")).tolist() == [[1.171875, 0.0, 5.859375, 0.0]]
    for bad in (TEXT.replace("3D_", "2D_"), "3D_Camera_Calibration 1 2", TEXT.replace("2020 2 29", "2019 2 29"), TEXT.replace(" 40 ", " -1 "), TEXT.replace("2.5", "nan"), "", TEXT.replace("14 57", "14.5 57")):
        with pytest.raises(CalibrationError):
            parse_calibration(bad, 4)
    with pytest.raises(ValueError):
        c.apply(np.zeros((2, 3), "u2"))


def test_navigation(spark, tmp_path):
    (tmp_path / "gps").write_text("10 1 2 0\n\nx 1 2 3\n20 2 4 0 9\n30 nan 5 0\n5 7\n")
    rows = numeric_rows(spark, str(tmp_path / "gps"), 4).collect()
    assert [r.v[0] for r in rows] == [10, 20, 30] and math.isnan(rows[2].v[1])
    assert numeric_rows(spark, str(tmp_path / "none"), 4).count() == 0
    track = spark.createDataFrame([("a", 10.0, 1.0), ("a", 20.0, 3.0), ("b", 0.0, 0.0)], "set_id string, frame double, v double")
    probes = spark.createDataFrame([("a", f) for f in (9.0, 10.0, 15.0, 19.999999999999, 20.0, 20.5)] + [("b", 0.0), ("c", 1.0)], "set_id string, f double")
    got = {(r.set_id, r.f): r.v for r in interpolated(probes, "f", track, ["v"]).collect()}
    assert got == {("a", 9.0): None, ("a", 10.0): 1.0, ("a", 15.0): 2.0, ("a", 19.999999999999): 3.0, ("a", 20.0): 3.0, ("a", 20.5): None, ("b", 0.0): 0.0, ("c", 1.0): None}


def test_repeated_frames_and_long_tracks(spark):
    """The first row of a frame ends a line, the last one begins it; a million rows of one key take seconds and are many tasks."""
    rows = [("7", 0, 10.0, 1.0), ("7", 1, 10.0, 5.0), ("7", 2, 20.0, 9.0), ("7", 3, 20.0, 2.0), ("7", 4, 30.0, 4.0), ("8", 0, float("nan"), 3.0), ("8", 1, None, 3.0)]
    track = spark.createDataFrame(rows, "set_id string, line long, frame double, v double")
    asked = {5.0: None, 10.0: 1.0, 15.0: 7.0, 20.0 * (1 - 1e-10): 9.0, 20.0: 9.0, 25.0: 3.0, 30.0: 4.0, 31.0: None}
    probes = spark.createDataFrame([(s, f) for s in ("7", "8") for f in asked] + [("7", None)], "set_id string, at double")
    for span in (65536.0, 4.0):
        got = {(r.set_id, r["at"]): r.v for r in survey.interpolated(probes, "at", track, ["v"], span=span).collect()}
        assert len(got) == 17 and all(got["7", f] == (None if v is None else pytest.approx(v)) for f, v in asked.items()) and got["7", None] is None
        assert all(v is None for (s, _), v in got.items() if s == "8")
    long = spark.range(1_000_000).select(F.lit("7").alias("set_id"), F.col("id").alias("line"), (F.col("id") * 2.0).alias("frame"), (F.col("id") * 3.0).alias("v"))
    many = spark.range(200_000).select(F.lit("7").alias("set_id"), (F.col("id") * 9.0 + 1).alias("at"))
    began = time.perf_counter()
    off = survey.interpolated(many, "at", long, ["v"]).agg(F.max(F.abs(F.col("v") - F.col("at") * 1.5)), F.count("v")).first()
    assert off[0] < 1e-6 and off[1] == 200_000 and time.perf_counter() - began < 60


def test_interpolation_deals_rows_out_however_well_they_compress(spark):
    """No task holds much of a track or of the probes; before, the sorted rows of half a million frames were those of one task."""
    track = spark.range(500_000).select(F.lit("7").alias("set_id"), (F.col("id") * 2.0).alias("frame"), F.lit(1.5).alias("v"))
    probes = spark.range(100_000).select(F.lit("7").alias("set_id"), (F.col("id") * 9.0).alias("at"))
    got = survey.interpolated(probes, "at", track, ["v"], span=1024.0)
    of_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(of_task) == 100_000 and max(of_task) < 12_500 and got.filter("v = 1.5").count() == 100_000


def test_a_large_set_is_indexed_by_many_tasks(spark):
    """Each file's end against a plain loop, over the borders of ranges, with files of one frame; before, a set was one task."""
    rng = np.random.default_rng(3)
    rows = [("1", f"93/{'aB'[k % 2]}{k}", float(f)) for k, f in enumerate(rng.integers(0, 30_000, 20_000))] + [("2", "93/x", 5.0), ("3", "93/y", 7.0), ("3", "93/Y", 7.0)]
    got = survey.end_frames(spark.createDataFrame(rows, "set_id string, relative_path string, start_frame double"))
    of_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(of_task) == len(rows) and max(of_task) < 10_000
    want = {}
    for name in ("1", "2", "3"):
        mine = sorted((r for r in rows if r[0] == name), key=lambda r: (r[2], r[1].lower(), r[1]))
        steps = [b[2] - a[2] for a, b in zip(mine, mine[1:]) if b[2] > a[2]]
        usual = float(np.median(steps)) if steps else 1.0
        want |= {a[:2]: b if b is not None and b > a[2] else a[2] + usual for a, b in zip(mine, [r[2] for r in mine[1:]] + [None])}
    assert {(r.set_id, r.relative_path): r.end_frame for r in got.collect()} == want
