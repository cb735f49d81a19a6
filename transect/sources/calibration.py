"""Camera calibrations: text record, height resolution, raw heights to inches."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transect.config import COLUMNS
from transect.functions.scalars import finite

#: Fixed values of the record: its first token, and how many values come after the offsets at least.
HEADER, TAIL = "3D_Camera_Calibration", 13


class CalibrationError(ValueError):
    """A record that is no calibration."""


@dataclass(frozen=True, eq=False)
class Calibration:
    offsets: np.ndarray
    camera_horizontal: float
    laser_horizontal: float
    camera_height: float
    pavement_width: float
    terms: tuple[float, float]
    laser_height: float
    recorded_resolution: float
    calibrated_at: datetime
    extra: tuple[float, ...] = ()

    def __post_init__(self):
        if not len(self.offsets) or not np.isfinite(self.offsets).all():
            raise CalibrationError("height offsets must be finite")
        if self.pavement_width <= 0 or self.recorded_resolution <= 0:
            raise CalibrationError("pavement width and height resolution must be positive")

    @property
    def pixel_width(self) -> float:
        return self.pavement_width / len(self.offsets)

    @property
    def resolution(self) -> float:
        """Inches of height for one raw unit, from the geometry; the recorded value isn't used."""
        below = 16.0 * (self.camera_horizontal * self.laser_height + self.laser_horizontal * self.camera_height)
        if below == 0:
            raise CalibrationError("the calibration's geometry has no height resolution")
        value = self.pixel_width * math.hypot(self.camera_horizontal, self.camera_height) * self.laser_height / below
        if not math.isfinite(value) or value <= 0:
            raise CalibrationError("the height resolution must be positive")
        return value

    def x(self) -> np.ndarray:
        return np.arange(len(self.offsets)) * self.pixel_width

    def apply(self, raw: np.ndarray) -> np.ndarray:
        """Inches of raw heights; the last axis runs over columns."""
        raw = np.asarray(raw)
        if not raw.ndim or raw.shape[-1] != len(self.offsets):
            raise ValueError(f"raw heights must have {len(self.offsets)} columns")
        if raw.dtype.kind not in "iu" and raw.dtype.kind != "f":
            raise TypeError("raw heights must be numbers")
        return (raw.astype(float) - self.offsets) * self.resolution


def _number(token: str, what: str) -> float:
    try:
        value = float(token)
    except ValueError:
        raise CalibrationError(f"{what} {token!r} is not a number") from None
    if not math.isfinite(value):
        raise CalibrationError(f"{what} must be finite")
    return value


def parse_calibration(text: str, columns: int = COLUMNS) -> Calibration:
    """A calibration record: header, an offset for each column, 13 values, more numbers."""
    if columns <= 0:
        raise ValueError("columns must be positive")
    tokens = text.lstrip("﻿").split()
    if not tokens:
        raise CalibrationError("the calibration is empty")
    if tokens[0] != HEADER:
        raise CalibrationError(f"unexpected header {tokens[0]!r}; expected {HEADER!r}")
    if len(tokens) - 1 < columns + TAIL:
        raise CalibrationError(f"{len(tokens) - 1} values; at least {columns + TAIL} are needed for {columns} columns")
    numbers = [_number(t, f"value {k}") for k, t in enumerate(tokens[1:])]
    offsets, tail = np.array(numbers[:columns]), numbers[columns:]
    when = tail[8:13]
    if any(v != int(v) for v in when):
        raise CalibrationError("parts of the date must be whole numbers")
    try:
        at = datetime(*map(int, when))
    except (ValueError, OverflowError) as e:
        raise CalibrationError(f"invalid date: {e}") from None
    return Calibration(offsets, tail[0], tail[1], tail[2], tail[3], (tail[4], tail[5]), tail[6], tail[7], at, tuple(tail[13:]))


def read_calibration(spark: SparkSession, path: str, columns: int = COLUMNS) -> Calibration:
    """The calibration in a file of any store that Spark reads; one row, so it is parsed on the driver."""
    rows = spark.read.format("binaryFile").load(path).select("content").collect()
    if len(rows) != 1:
        raise CalibrationError(f"{path} names {len(rows)} files")
    try:
        return parse_calibration(bytes(rows[0].content).decode("utf-8-sig"), columns)
    except UnicodeDecodeError:
        raise CalibrationError(f"{path} is not UTF-8 text") from None


def calibrations(spark: SparkSession, path: str, columns: int = COLUMNS) -> DataFrame:
    """calibrations_of() the text files at a path."""
    return calibrations_of(spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), "value"), columns)


def calibrations_of(records: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """(path, offsets, camera_horizontal ... resolution, calibrated_at, extra) of many records (path, value), in columns only; records that parse_calibration() refuses are left out."""
    words = F.split(F.trim(F.regexp_replace("value", r"[\s﻿]+", " ")), " ")
    text = records.select("path", words.alias("w"))
    text = text.filter((F.element_at("w", 1) == HEADER) & (F.size("w") > columns + TAIL))
    text = text.select("path", F.transform(F.slice("w", 2, 1 << 30), lambda t: t.try_cast("double")).alias("v")).filter(F.forall("v", lambda x: finite(x).isNotNull()))
    tail = [F.element_at("v", columns + 1 + k) for k in range(TAIL)]
    text = text.filter(F.forall(F.slice("v", columns + 9, 5), lambda t: t == F.floor(t)))
    named = text.select(
        "path", F.slice("v", 1, columns).alias("offsets"), *[t.alias(n) for t, n in zip(tail[:4], ("camera_horizontal", "laser_horizontal", "camera_height", "pavement_width"), strict=True)],
        F.array(tail[4], tail[5]).alias("terms"), tail[6].alias("laser_height"), tail[7].alias("recorded_resolution"),
        F.try_make_timestamp_ntz(*[t.cast("int") for t in tail[8:13]], F.lit(0)).alias("calibrated_at"), F.slice("v", columns + TAIL + 1, 1 << 30).alias("extra"),
    )
    return named.filter("pavement_width > 0 AND recorded_resolution > 0 AND calibrated_at IS NOT NULL").withColumn(
        "resolution", resolution_of(F.col("pavement_width") / columns, F.col("camera_horizontal"), F.col("laser_horizontal"), F.col("camera_height"), F.col("laser_height"))
    )


def resolution_of(pixel_width: Column, camera_horizontal: Column, laser_horizontal: Column, camera_height: Column, laser_height: Column) -> Column:
    """Height resolution as an expression; null where the geometry has none."""
    return F.try_divide(pixel_width * F.hypot(camera_horizontal, camera_height) * laser_height, 16.0 * (camera_horizontal * laser_height + laser_horizontal * camera_height))


def calibrated(raw: Column, offsets: Column, resolution: Column) -> Column:
    """Raw heights in inches, element by element."""
    return F.zip_with(raw, offsets, lambda r, o: (r - o) * resolution)
