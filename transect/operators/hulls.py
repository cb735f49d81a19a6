"""Straightedge operators in columns: upper hull, supporting line, footprint sweep, residual noise. No Python worker, no shuffle.

A profile is a row with arrays x (rising) and y. Each operator is one or a few passes over the arrays by aggregate(), whose
state is a struct or a stack; nothing looks for a place by scanning all samples for every sample.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from transect.config import BAR_LENGTH, FOOTPRINT_WIDTH, Lane
from transect.operators.arrays import total
from transect.operators.geometry import EPS, FINE, PLACES, ROUNDS

POINTS = "array<struct<x:double,y:double>>"
#: Samples of which a hull is made by itself before it is joined with the others.
BLOCK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def pairs(x: Column, y: Column) -> Column:
    """Samples as an array of points."""
    return F.zip_with(x, y, lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")))


def _chain(points: Column) -> Column:
    """Upper hull of points in order of x, a stack on which each point lies after those that it covers are taken off."""

    def turns_up(a: Column, b: Column, p: Column) -> Column:
        one, two = (b["x"] - a["x"]) * (p["y"] - b["y"]), (b["y"] - a["y"]) * (p["x"] - b["x"])
        return one - two >= -32 * EPS * F.greatest(F.lit(1.0), F.abs(one), F.abs(two))

    def push(stack: Column, p: Column) -> Column:
        # Points are taken off from the top while they lie under the line from the one below to the new one, so the last that doesn't stays on top.
        firm = F.filter(F.sequence(F.lit(2), F.size(stack)), lambda m: ~turns_up(F.element_at(stack, m - 1), F.element_at(stack, m), p))
        top = F.when(F.size(stack) < 2, F.size(stack)).otherwise(F.coalesce(F.try_element_at(firm, F.lit(-1)), F.lit(1)))
        return F.concat(F.slice(stack, 1, top), F.array(p))

    return F.aggregate(points, F.array().cast(POINTS), push)


def upper_hull(points: Column) -> Column:
    """Vertices of the least concave line over points in order of x; of points on one line the outer two. Hulls of blocks are made first and joined by the hull of their vertices, which are few."""
    n = F.size(points)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda k: _chain(F.slice(points, k * BLOCK + 1, BLOCK)))
    return F.when(n > BLOCK, _chain(F.flatten(blocks))).otherwise(_chain(points))


def supporting_line(hull: Column, c: Column | float, hint: Column | float) -> Column:
    """struct(slope, height, left_x, right_x): the line through the hull over x = c, its height there and its contacts; null where the hull doesn't reach over c. On a vertex the slope is the one nearest to the hint of those that fit."""
    c, hint = (v if isinstance(v, Column) else F.lit(v) for v in (c, hint))
    return let(hull, lambda h: _line_through(h, c, hint))


def _line_through(hull: Column, c: Column, hint: Column) -> Column:
    def line(slope: Column, height: Column, left: Column, right: Column) -> Column:
        return F.struct(slope.alias("slope"), height.alias("height"), left.alias("left_x"), right.alias("right_x"))

    def of(at: Column) -> Column:
        v, before, after = F.get(hull, at), F.get(hull, at - 1), F.get(hull, at + 1)
        chord = (v["y"] - before["y"]) / (v["x"] - before["x"])
        steep, flat = F.when(at > 0, chord).otherwise(F.lit(float("inf"))), F.when(at + 1 < F.size(hull), (after["y"] - v["y"]) / (after["x"] - v["x"])).otherwise(F.lit(float("-inf")))

        def same(a: Column, b: Column) -> Column:
            return F.abs(a - b) <= 1e-12 * F.greatest(F.lit(1.0), F.abs(a), F.abs(b))

        def on_vertex(slope: Column) -> Column:
            return F.when((at > 0) & same(slope, steep), line(slope, v["y"], before["x"], v["x"])).when((at + 1 < F.size(hull)) & same(slope, flat), line(slope, v["y"], v["x"], after["x"])).otherwise(line(slope, v["y"], v["x"], v["x"]))

        exact = F.abs(v["x"] - c) <= 16 * EPS * F.greatest(F.lit(1.0), F.abs(c))
        return F.when(exact, let(F.least(F.greatest(hint, flat), steep), on_vertex)).otherwise(line(chord, before["y"] + chord * (c - before["x"]), before["x"], v["x"]))

    reaches = (F.size(hull) > 1) & (F.get(hull, F.lit(0))["x"] <= c) & (F.element_at(hull, -1)["x"] >= c)
    return F.when(reaches, let(F.size(F.filter(hull, lambda p: p["x"] < c)), of))


def bar(points: Column, hint: Column, lane: Lane, side: str, length: float = BAR_LENGTH) -> Column:
    """struct(slope, height, left_x, right_x, supports) of a straightedge that lies on the wheel path's half of the lane: tilt and supports settle in a few rounds, as its reach follows its tilt. Null where it isn't carried."""
    c, (low, high) = lane.wheel_center(side), lane.half(side)
    if not low < c < high:
        return F.lit(None).cast("struct<slope:double,height:double,left_x:double,right_x:double,supports:int>")
    state = "struct<slope:double,height:double,left_x:double,right_x:double,supports:int,carried:boolean,settled:boolean>"

    def turn(s: Column, _: Column) -> Column:
        reach = length / 2.0 / F.hypot(F.lit(1.0), s["slope"])
        inside = F.filter(points, lambda p: (p["x"] >= F.greatest(F.lit(low), c - reach)) & (p["x"] <= F.least(F.lit(high), c + reach)))

        def told(held: Column) -> Column:
            def settled(line: Column) -> Column:
                close = F.abs(line["slope"] - s["slope"]) <= 1e-12 * F.greatest(F.lit(1.0), F.abs(line["slope"]), F.abs(s["slope"]))
                known = F.struct(line["slope"].alias("slope"), line["height"].alias("height"), line["left_x"].alias("left_x"), line["right_x"].alias("right_x"), F.size(held).alias("supports"), F.lit(True).alias("carried"), close.alias("settled"))
                none = F.struct(s["slope"].alias("slope"), s["height"].alias("height"), s["left_x"].alias("left_x"), s["right_x"].alias("right_x"), F.size(held).alias("supports"), F.lit(False).alias("carried"), F.lit(True).alias("settled"))
                return F.when(line.isNotNull(), known).otherwise(none)

            return let(supporting_line(upper_hull(held), F.lit(c), s["slope"]), settled)

        return F.when(s["settled"], s).otherwise(let(inside, told)).cast(state)

    first = F.struct(hint.alias("slope"), F.lit(0.0).alias("height"), F.lit(0.0).alias("left_x"), F.lit(0.0).alias("right_x"), F.lit(0).alias("supports"), F.lit(True).alias("carried"), F.lit(False).alias("settled")).cast(state)
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, turn)
    return let(done, lambda s: F.when(s["carried"], F.struct(*[s[n].alias(n) for n in ("slope", "height", "left_x", "right_x", "supports")])))


def deepest_footprint(points: Column, low: Column, high: Column, line: Column, c: float, width: float = FOOTPRINT_WIDTH) -> Column:
    """struct(at, over, most, points): where a footprint centred from low to high lies deepest under a line (slope, height at c), how high the line is over the surface's mean there, the most that it is anywhere (0 if it is nowhere above), and the samples under it. Of depths equal to PLACES the first.

    The height of the line over the mean changes by slope - (surface at the right edge - surface at the left edge) / width, which
    is linear until an edge passes a sample. So one sweep over the places where an edge does sums it from piece to piece, and
    each piece's own largest value is known in closed form.
    """
    half, last = width / 2.0, F.size(points) - 1

    def incline(k: Column) -> Column:
        a, b = F.get(points, F.least(k, last - 1)), F.get(points, F.least(k, last - 1) + 1)
        return (b["y"] - a["y"]) / (b["x"] - a["x"])

    def passed(sign: float, right: bool) -> Column:
        return F.transform(points, lambda p, k: F.struct(F.least(F.greatest(p["x"] + sign * half, low), high).alias("at"), k.alias("k"), F.lit(right).alias("right"), incline(k).alias("rise")))

    def area(k: Column) -> Column:
        """Surface under the first footprint between samples k and k + 1."""
        a = F.get(points, k)
        begin, end = (F.least(F.greatest(v, low - half), low + half) for v in (a["x"], F.get(points, k + 1)["x"]))
        return (end - begin) * (a["y"] + incline(k) * ((begin + end) / 2.0 - a["x"]))

    def surface(at: Column) -> Column:
        k = F.least(F.greatest(F.size(F.filter(points, lambda p: p["x"] <= at)) - 1, F.lit(0)), last - 1)
        return let(k, lambda j: F.get(points, j)["y"] + incline(j) * (at - F.get(points, j)["x"]))

    slope, state = line["slope"], "struct<at:double,over:double,rate:double,left:double,right:double,most:double,rank:double,held:double,spot:double>"
    tilt = F.hypot(F.lit(1.0), slope)

    def ranked(over: Column) -> Column:
        return F.rint(F.rint(F.greatest(over, F.lit(0.0)) / tilt * 10.0**FINE) / 10.0 ** (FINE - PLACES))

    def step(s: Column, e: Column) -> Column:
        length, bend = e["at"] - s["at"], (s["left"] - s["right"]) / width
        inner = (s["rate"] > 0) & (s["rate"] + bend * length < 0)
        top = F.when(inner, -s["rate"] / bend).otherwise(F.lit(0.0))
        over, peak = s["over"] + length * (s["rate"] + bend * length / 2.0), F.when(inner, s["over"] + s["rate"] * top / 2.0).otherwise(s["over"])

        def weighed(v: Column) -> Column:
            # The peak inside the piece comes before its end.
            return F.struct(v["over"].alias("over"), v["peak"].alias("peak"), v["top"].alias("top"), ranked(v["over"]).alias("last"), ranked(v["peak"]).alias("first"))

        def ended(v: Column) -> Column:
            first, then = v["first"] > s["rank"], v["last"] > F.greatest(s["rank"], v["first"])
            return F.struct(
                e["at"].alias("at"), v["over"].alias("over"), (s["rate"] + bend * length).alias("rate"), F.when(e["right"], s["left"]).otherwise(e["rise"]).alias("left"), F.when(e["right"], e["rise"]).otherwise(s["right"]).alias("right"),
                F.greatest(s["most"], v["peak"], v["over"]).alias("most"), F.greatest(s["rank"], v["first"], v["last"]).alias("rank"),
                F.when(then, v["over"]).when(first, v["peak"]).otherwise(s["held"]).alias("held"), F.when(then, e["at"]).when(first, s["at"] + v["top"]).otherwise(s["spot"]).alias("spot"),
            ).cast(state)

        return let(let(F.struct(over.alias("over"), peak.alias("peak"), top.alias("top")), weighed), ended)

    events = F.array_sort(F.concat(passed(-1.0, True), passed(1.0, False)))
    end = F.array(F.struct(high.alias("at"), F.lit(0).alias("k"), F.lit(True).alias("right"), F.lit(0.0).alias("rise")))
    mean = total(F.transform(F.sequence(F.lit(0), last - 1), area)) / width
    over = line["height"] + slope * (low - c) - mean
    first = F.struct(low.alias("at"), over.alias("over"), (slope - (surface(low + half) - surface(low - half)) / width).alias("rate"), incline(F.lit(0)).alias("left"), incline(F.lit(0)).alias("right"), F.greatest(over, F.lit(0.0)).alias("most"), ranked(over).alias("rank"), over.alias("held"), low.alias("spot")).cast(state)
    done = let(first, lambda s: F.aggregate(F.concat(events, end), s, step))
    return let(done, lambda s: F.struct(s["spot"].alias("at"), s["held"].alias("over"), s["most"].alias("most"), F.size(F.filter(points, lambda p: (p["x"] >= s["spot"] - half) & (p["x"] <= s["spot"] + half))).alias("points")))


def rut(x: Column, y: Column, hint: Column, lane: Lane, side: str, length: float = BAR_LENGTH, width: float = FOOTPRINT_WIDTH) -> Column:
    """struct(depth, rut_x, rut_y, bar_slope, left_x, right_x, supports, footprint_points) of a trimmed profile; null where the bar isn't carried or no footprint fits. One expression: a filter on it that Spark moves below costs it once more and no more than that."""
    c, zone = lane.wheel_center(side), lane.wheel_zone(side)

    def under(points: Column, line: Column) -> Column:
        reach = length / 2.0 / F.hypot(F.lit(1.0), line["slope"])
        low = F.greatest(F.lit(zone[0]), c - reach, line["left_x"], F.element_at(points, 1)["x"]) + width / 2.0
        high = F.least(F.lit(zone[1]), c + reach, line["right_x"], F.element_at(points, -1)["x"]) - width / 2.0
        return let(F.struct(low.alias("low"), high.alias("high")), lambda z: F.when(z["low"] <= z["high"], let(deepest_footprint(points, z["low"], z["high"], line, c, width), lambda d: told(line, d))))

    def told(line: Column, d: Column) -> Column:
        depth = d["most"] / F.hypot(F.lit(1.0), line["slope"])
        return F.struct(
            F.when(depth < 64 * EPS, 0.0).otherwise(depth).alias("depth"), d["at"].alias("rut_x"), (line["height"] + line["slope"] * (d["at"] - c) - d["over"]).alias("rut_y"), line["slope"].alias("bar_slope"),
            line["left_x"].alias("left_x"), line["right_x"].alias("right_x"), line["supports"].alias("supports"), d["points"].alias("footprint_points"),
        )

    return let(pairs(x, y), lambda points: let(bar(points, hint, lane, side, length), lambda line: F.when(line.isNotNull(), under(points, line))))


def residual_noise(x: Column, y: Column, window: float) -> Column:
    """Root mean square of what a running mean over about `window` inches (mirrored at the ends) leaves: one pass with a running sum. 0 for fewer than three samples."""
    n = F.size(x)
    steps = F.array_sort(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.get(x, i) - F.get(x, i - 1)))
    spacing = let(steps, lambda s: (F.get(s, F.floor((n - 2) / 2).cast("int")) + F.get(s, F.floor((n - 1) / 2).cast("int"))) / 2.0)
    arm = F.least(F.greatest(F.lit(1), F.floor(F.rint(window / spacing) / 2)), F.floor((n - 1) / 2)).cast("int")
    level = let(total(y) / n, lambda m: F.transform(y, lambda v: v - m))

    def of(level: Column, arm: Column) -> Column:
        def at(i: Column) -> Column:
            inside = F.abs(i)
            return F.get(level, F.when(inside > n - 1, 2 * (n - 1) - inside).otherwise(inside).cast("int"))

        size = 2 * arm + 1
        begin = F.aggregate(F.sequence(-arm - 1, arm - 1), F.lit(0.0), lambda a, i: a + at(i))
        first = F.struct(begin.alias("sum"), F.lit(0.0).alias("rest"))

        def step(s: Column, i: Column) -> Column:
            def moved(now: Column) -> Column:
                rest = F.get(level, i) - now / size
                return F.struct(now.alias("sum"), (s["rest"] + rest * rest).alias("rest"))

            return let(s["sum"] + at(i + arm) - at(i - arm - 1), moved)

        return F.sqrt(F.aggregate(F.sequence(F.lit(0), n - 1), first, step)["rest"] / n)

    return F.when(n < 3, 0.0).otherwise(let(F.struct(level.alias("l"), arm.alias("a")), lambda v: of(v["l"], v["a"])))
