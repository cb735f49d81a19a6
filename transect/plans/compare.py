"""Comparison of measured with expected values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transect.functions.scalars import finite

#: Tolerances of a comparison, in inches, percent points or degrees.
TOLERANCES = {"reduced": 1e-6, "slope": 1e-4, "depth": 1e-3, "geometry": 1e-2}


def error_summary(rows: DataFrame, expected: Column, actual: Column, tolerance: float, by: list[str]) -> DataFrame:
    """(by..., max_error, rmse, passed, n): errors of a pair of columns. A pair passes if it is within the tolerance, or both are missing; one that is missing alone fails and has no error."""
    a, b = finite(expected), finite(actual)
    error = F.abs(a - b)
    good = F.coalesce(error <= tolerance, a.isNull() & b.isNull())
    return rows.groupBy(*by).agg(F.max(error).alias("max_error"), F.sqrt(F.avg(error * error)).alias("rmse"), F.count_if(good).alias("passed"), F.count("*").alias("n"))


def matched(expected: DataFrame, actual: DataFrame, keys: list[str], values: list[str], tolerance: float) -> DataFrame:
    """(value, max_error, rmse, passed, n, alone): a full join of both tables on keys, one row for each compared column; a row on one side only fails everywhere."""
    both = expected.select(*keys, F.struct(*values).alias("e")).join(actual.select(*keys, F.struct(*values).alias("a")), keys, "full")
    each = [F.struct(F.lit(v).alias("value"), F.col(f"e.{v}").cast("double").alias("x"), F.col(f"a.{v}").cast("double").alias("y"), (F.col("e").isNull() != F.col("a").isNull()).alias("alone")) for v in values]
    rows = both.select(F.inline(F.array(*each)))
    error = F.abs(finite(F.col("x")) - finite(F.col("y")))
    good = ~F.col("alone") & F.coalesce(error <= tolerance, F.col("x").isNull() & F.col("y").isNull())
    return rows.groupBy("value").agg(F.max(error).alias("max_error"), F.sqrt(F.avg(error * error)).alias("rmse"), F.count_if(good).alias("passed"), F.count("*").alias("n"), F.count_if("alone").alias("alone"))
