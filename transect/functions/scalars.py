"""Column expressions: severity, finite values, closeness, frames of time codes, names, rounding, metrics."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Depths in inches at which the severity classes 1, 2 and 3 begin.
SEVERITY_LIMITS = (0.25, 0.5, 1.0)


def finite(value: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    value = value.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(math.inf)), value)


def severity(depth: Column, limits: tuple[float, float, float] = SEVERITY_LIMITS, allow_negative: bool = False) -> Column:
    """Class 0 to 3 of a depth, -1 for none. A negative depth is an error unless allow_negative, then it is class 0."""
    a, b, c = limits
    if not 0 <= a < b < c:
        raise ValueError("severity limits must rise and not be negative")
    depth = finite(depth)
    out = F.when(depth.isNull(), -1)
    if not allow_negative:
        out = out.when(depth < 0, F.raise_error(F.lit("rut depth cannot be negative")).cast("int"))
    return out.when(depth < a, 0).when(depth < b, 1).when(depth < c, 2).otherwise(3)


def is_close(a: Column, b: Column, rel: float = 1e-9, absolute: float = 0.0) -> Column:
    """Whether two numbers differ by no more than a share of the larger one or an absolute amount."""
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def overall(left: Column, right: Column) -> Column:
    """Mean of both sides, null unless both are finite."""
    return (finite(left) + finite(right)) / 2.0


#: HHMMSSFF and a letter at the end of a stem; ASCII digits.
TIMECODE = r"([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})[A-Za-z]$"


def frame_of(stem: Column, fps: int = 30) -> Column:
    """Frame number of a stem that ends in a time code; null where minutes, seconds or frames are out of range or there is no code. Hours have no limit."""
    if fps <= 0:
        raise ValueError("fps must be positive")
    h, m, s, f = (F.regexp_extract(stem, TIMECODE, k) for k in (1, 2, 3, 4))
    h, m, s, f = (F.when(stem.rlike(TIMECODE), x.try_cast("int")) for x in (h, m, s, f))
    return F.when((m < 60) & (s < 60) & (f < fps), (((h * 60 + m) * 60 + s) * fps + f).cast("double"))


def frame_number(stem: str, fps: int = 30) -> float | None:
    """frame_of() of one stem."""
    if fps <= 0:
        raise ValueError("fps must be positive")
    if (code := re.search(TIMECODE, stem, re.ASCII)) is None or stem.endswith("\n"):
        return None
    h, m, s, f = map(int, code.groups())
    return float(((h * 60 + m) * 60 + s) * fps + f) if m < 60 and s < 60 and f < fps else None


def stem_of(path: Column) -> Column:
    """File name without folder and last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def preview_name(severity_class: Column, frame: Column, file_name: Column) -> Column:
    """Name of a preview, null unless the class is 2 or 3 and the frame is a whole number."""
    label = F.when(severity_class == 2, "moderate").when(severity_class == 3, "high")
    whole = F.when(frame == F.floor(frame), frame.cast("bigint").cast("string"))
    return F.concat(label, F.lit("_"), whole, F.lit("_"), stem_of(file_name), F.lit(".png"))


def duration(seconds: Column) -> Column:
    """HH:MM:SS of rounded seconds (halves to even), n/a where there are none."""
    total = F.greatest(F.lit(0), F.rint(finite(seconds)).cast("bigint"))
    return F.coalesce(F.format_string("%02d:%02d:%02d", F.floor(total / 3600), F.floor(total / 60) % 60, total % 60), F.lit("n/a"))


def utilisation(cpu_seconds: float, wall_seconds: float, workers: int) -> dict[str, float]:
    """Speedup (CPU seconds over wall seconds) and efficiency (that over workers)."""
    if workers <= 0:
        raise ValueError("workers must be positive")
    if not (math.isfinite(wall_seconds) and wall_seconds > 0 and math.isfinite(cpu_seconds) and cpu_seconds >= 0):
        raise ValueError("times must be finite, wall time positive and CPU time not negative")
    speedup = cpu_seconds / wall_seconds
    return {"speedup": speedup, "efficiency": speedup / workers, "efficiency_percent": 100.0 * speedup / workers}


def grayscale(value: Column, low: Column, high: Column) -> Column:
    """0 to 255 between two limits, halves to even; half-way where the limits meet, 0 for no value."""
    share = F.when(high <= low, F.lit(0.5)).otherwise(F.least(F.greatest((value - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)))
    return F.coalesce(F.rint(F.when(finite(value).isNotNull(), share) * 255.0).cast("int"), F.lit(0))
