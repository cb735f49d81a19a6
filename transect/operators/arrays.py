"""Array and relational forms of the profile operators, in columns only.

A profile is a row with arrays x and y (null: invalid sample). Array forms are narrow: no shuffle, whatever the number of
profiles. Forms that look along a profile for the nearest sample or a run work on points(), one row for each sample, in
windows of one profile, whose size is the number of scan columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transect.config import Lane
from transect.operators.geometry import RUN_SEGMENTS, RUN_SLOPE, SEARCH_SHARE, STEEP_SLOPE


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def mean(values: Column) -> Column:
    """Mean of the non-null values; null without any."""
    good = F.filter(values, lambda v: v.isNotNull())
    return F.try_divide(total(good), F.size(good))


def deviation(values: Column) -> Column:
    """Sample deviation of the non-null values; null for fewer than two."""
    good = F.filter(values, lambda v: v.isNotNull())
    middle = F.array(mean(good))
    squares = F.flatten(F.transform(middle, lambda m: F.transform(good, lambda v: (v - m) * (v - m))))
    return F.when(F.size(good) > 1, F.sqrt(F.try_divide(total(squares), F.size(good) - 1)))


def grid(n: Column | int, width: Column | float) -> Column:
    """x of n columns of a pixel width."""
    count, step = (v if isinstance(v, Column) else F.lit(v) for v in (n, width))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: i * step)


def keep(df: DataFrame, condition) -> DataFrame:
    """df with arrays x and y cut down to the samples for which condition(x, y) holds."""
    pairs = F.filter(F.arrays_zip("x", "y"), lambda p: condition(p["x"], p["y"]))
    return df.withColumn("__p", pairs).withColumns({"x": F.col("__p.x"), "y": F.col("__p.y")}).drop("__p")


def crop(df: DataFrame, left: float, right: float) -> DataFrame:
    """Samples from left to right, both ends included."""
    return keep(df, lambda x, y: (x >= left) & (x <= right))


def inside_lane(df: DataFrame, lane: Lane) -> DataFrame:
    """Samples strictly inside the lane."""
    return keep(df, lambda x, y: (x > lane.left) & (x < lane.right))


def valid_fraction(y: Column) -> Column:
    """Share of samples that aren't null."""
    return F.try_divide(F.size(F.filter(y, lambda v: v.isNotNull())).cast("double"), F.size(y))


def within_sigma(df: DataFrame, k: float = 3.5) -> DataFrame:
    """Samples within k sample deviations of the mean; all where there is no spread."""
    marked = df.withColumns({"__m": mean(F.col("y")), "__s": deviation(F.col("y"))})
    pairs = F.filter(F.arrays_zip("x", "y"), lambda p: F.coalesce(F.col("__s") == 0, F.lit(True)) | (F.abs(p["y"] - F.col("__m")) <= k * F.col("__s")))
    return marked.withColumn("__p", pairs).withColumns({"x": F.col("__p.x"), "y": F.col("__p.y")}).drop("__p", "__m", "__s")


def smoothed(df: DataFrame, points: int = 19, drop_last: bool = True) -> DataFrame:
    """Means of each whole window of x and of y; the last one left out if drop_last. Arrays that have no window become empty."""
    windows = F.size("x") - points + (0 if drop_last else 1)

    def means(c: str) -> Column:
        return F.when(windows > 0, F.transform(F.sequence(F.lit(1), F.greatest(windows, F.lit(1))), lambda i: total(F.slice(c, i, points)) / points)).otherwise(F.array().cast("array<double>"))

    return df.withColumns({"x": means("x"), "y": means("y")})


def batch_noise(y: Column, batch: int = 30) -> Column:
    """Median of the sample deviations of whole batches; 0 without one."""
    whole = F.floor(F.size(y) / batch).cast("int")
    each = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(whole, F.lit(1)) - 1), lambda i: deviation(F.slice(y, i * batch + 1, batch))))
    n = F.size(each)
    middle = (F.element_at(each, F.floor((n + 1) / 2).cast("int")) + F.element_at(each, F.floor(n / 2).cast("int") + 1)) / 2.0
    return F.when(whole > 0, middle).otherwise(F.lit(0.0))


def rolled(df: DataFrame, degrees: float) -> DataFrame:
    """Profiles turned clockwise about their first sample."""
    angle = F.radians(F.lit(degrees))
    c, s, x0, y0 = F.cos(angle), F.sin(angle), F.element_at("x", 1), F.element_at("y", 1)
    return df.withColumns({
        "x": F.zip_with("x", "y", lambda x, y: x0 + (x - x0) * c + (y - y0) * s),
        "y": F.zip_with("x", "y", lambda x, y: y0 - (x - x0) * s + (y - y0) * c),
    })


def slope_hint(df: DataFrame, lane: Lane) -> Column:
    """Least-squares slope of the samples in the closed lane, 0 where there is none."""
    pairs = F.filter(F.arrays_zip("x", "y"), lambda p: (p["x"] >= lane.left) & (p["x"] <= lane.right))
    xs, ys = F.transform(pairs, lambda p: p["x"]), F.transform(pairs, lambda p: p["y"])
    middles = F.array(F.struct(mean(xs).alias("x"), mean(ys).alias("y")))
    over = F.flatten(F.transform(middles, lambda m: F.transform(pairs, lambda p: (p["x"] - m["x"]) * (p["y"] - m["y"]))))
    under = F.flatten(F.transform(middles, lambda m: F.transform(pairs, lambda p: (p["x"] - m["x"]) * (p["x"] - m["x"]))))
    return F.when(F.size(pairs) > 1, F.coalesce(F.try_divide(total(over), total(under)), F.lit(0.0))).otherwise(F.lit(0.0))


def cross_slope(df: DataFrame, lane: Lane) -> DataFrame:
    """df with cs_percent, cs_degrees, cs_intercept, cs_r2, cs_points of the samples strictly inside the lane; null where a half is empty or the span is zero."""
    inner = F.filter(F.arrays_zip("x", "y"), lambda p: (p["x"] > lane.left) & (p["x"] < lane.right))
    one = df.withColumn("__p", inner).withColumns({
        "__l": F.filter("__p", lambda p: p["x"] <= lane.center), "__r": F.filter("__p", lambda p: p["x"] >= lane.center),
        "__run": (F.array_max("__p.x") - F.array_min("__p.x")) / 2.0,
    })
    two = one.withColumn("__fall", F.try_divide(mean(F.col("__l.y")) - mean(F.col("__r.y")), F.col("__run")))
    two = two.withColumn("cs_intercept", mean(F.col("__l.y")) + F.col("__fall") * mean(F.col("__l.x"))).withColumn("__m", mean(F.col("__p.y")))
    rest = total(F.transform("__p", lambda p: F.pow(p["y"] - F.col("cs_intercept") + F.col("__fall") * p["x"], F.lit(2.0))))
    spread = total(F.transform("__p", lambda p: F.pow(p["y"] - F.col("__m"), F.lit(2.0))))
    r2 = F.when(F.col("__fall").isNull(), None).when(spread <= 2.220446049250313e-16, 1.0).otherwise(1.0 - F.try_divide(rest, spread))
    out = two.withColumns({"cs_percent": 100.0 * F.col("__fall"), "cs_degrees": F.degrees(F.atan("__fall")), "cs_r2": r2, "cs_points": F.size("__p")})
    return out.drop("__p", "__l", "__r", "__run", "__fall", "__m")


def surface_at(at: Column) -> Column:
    """Height of the surface through arrays x and y at a position: on the line between its neighbours, null outside."""
    k = F.size(F.filter("x", lambda x: x <= at))
    x0, y0 = F.get("x", k - 1), F.get("y", k - 1)
    line = y0 + (at - x0) * F.try_divide(F.get("y", k) - y0, F.get("x", k) - x0)
    return F.when(k > 0, F.when(x0 == at, y0).otherwise(line))


def area_until(at: Column) -> Column:
    """Integral of the surface through arrays x and y from its first sample to a position inside it."""
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.size("x") - 1, F.lit(1))), lambda i: F.struct(F.element_at("x", i).alias("a"), F.element_at("y", i).alias("p"), F.get("x", i).alias("b"), F.get("y", i).alias("q")))

    def part(p):
        end = F.least(p["b"], at)
        height = p["p"] + (end - p["a"]) * (p["q"] - p["p"]) / (p["b"] - p["a"])
        return F.when(p["a"] < at, (end - p["a"]) * (p["p"] + height) / 2.0).otherwise(F.lit(0.0))

    inside = (at >= F.element_at("x", 1)) & (at <= F.element_at("x", -1))
    return F.when(inside, total(F.transform(pieces, part)))


def points(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., i, x, y), one row for each sample."""
    return df.select(*keys, F.posexplode(F.arrays_zip("x", "y")).alias("i", "p")).select(*keys, "i", "p.x", "p.y")


def gaps_filled(rows: DataFrame, keys: list[str], max_gap: float | None = None) -> DataFrame:
    """points() with inner nulls of y on the line between their neighbours, if those are at most max_gap apart."""
    known = F.when(F.col("y").isNotNull(), F.struct("x", "y"))
    run = Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    low, high = (F.last(known, ignorenulls=True).over(run.orderBy(way)) for way in (F.asc("i"), F.desc("i")))
    near = rows.withColumns({"__l": low, "__h": high})
    span = F.col("__h.x") - F.col("__l.x")
    line = F.col("__l.y") + (F.col("x") - F.col("__l.x")) * F.try_divide(F.col("__h.y") - F.col("__l.y"), span)
    able = F.lit(True) if max_gap is None else span <= max_gap
    return near.withColumn("y", F.coalesce("y", F.when(able, line))).drop("__l", "__h")


def shoulders_removed(rows: DataFrame, keys: list[str], lane: Lane, width: float) -> DataFrame:
    """points() between the shoulders and strictly inside the lane, by islands of steep segments; profiles of two samples and more."""
    order = Window.partitionBy(*keys).orderBy("i")
    whole = Window.partitionBy(*keys)
    left_at, right_at = lane.center - SEARCH_SHARE * width, lane.center + SEARCH_SHARE * width
    seg = rows.withColumn("__s", F.abs((F.lead("y").over(order) - F.col("y")) / (F.lead("x").over(order) - F.col("x"))))
    seg = seg.withColumns({
        "__ll": F.count_if(F.col("x") < left_at).over(whole), "__rl": F.count_if(F.col("x") <= right_at).over(whole) - 1,
        "__steep": F.coalesce(F.col("__s") > RUN_SLOPE, F.lit(False)),
    })
    seg = seg.withColumn("__island", F.sum(F.when(F.col("__steep"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = seg.filter("__steep").groupBy(*keys, "__island").agg(F.min("i").alias("a"), F.max("i").alias("b"), F.count("*").alias("n"), F.max("__s").alias("s"), F.first("__ll").alias("ll"), F.first("__rl").alias("rl"))
    runs = runs.filter((F.col("n") >= RUN_SEGMENTS) & (F.col("s") >= STEEP_SLOPE))
    cuts = runs.groupBy(*keys).agg(F.max(F.when(F.col("a") <= F.col("ll"), F.col("b") + 2)).alias("__start"), F.min(F.when(F.col("b") >= F.col("rl"), F.col("a"))).alias("__stop"))
    kept = rows.join(cuts, keys, "left").filter((F.col("i") >= F.coalesce("__start", F.lit(0))) & (F.col("i") < F.coalesce("__stop", F.lit(1 << 30))))
    return kept.filter((F.col("x") > lane.left) & (F.col("x") < lane.right)).drop("__start", "__stop")
