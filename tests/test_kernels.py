import math

import numpy as np
import pytest

from transect.config import Lane, Options, Reduction
from transect.operators.geometry import cross_slope, deepest_footprint, rut, rutting, shoulder_slice, slope_hint, support_line, without_shoulders
from transect.operators.measure import measure
from transect.operators.preview import height_image, png
from transect.operators.reduction import Profile, batch_noise, fill_gaps, reduce_profile, residual_noise, roll

LANE = Lane(0.0, 162.0)
X = np.arange(0, 162.0001, 0.125)


def bump(center, depth, sigma, x=X):
    return depth * np.exp(-0.5 * ((x - center) / sigma) ** 2)


def depths(y, **kwargs):
    return [s and s["depth"] for s in rutting(Profile(X, y), LANE, **kwargs)]


def test_lane_geometry():
    assert (LANE.center, LANE.wheel_center("left"), LANE.wheel_center("right")) == pytest.approx((81, 46.551181, 115.448819))
    assert LANE.wheel_zone("left") == pytest.approx((24.405511, 68.696851)) and LANE.wheel_zone("right") == pytest.approx((93.303149, 137.594489))
    for bad in ({"left": 5, "right": 5}, {"left": math.nan}, {"wheel_width": 0}, {"wheel_offset": -1}, {"center_offset": 81}):
        with pytest.raises(ValueError):
            Lane(**bad)


@pytest.mark.parametrize("slope", [0, 0.02, -0.035])
def test_a_plane_has_no_rut(slope):
    assert depths(3 + slope * X, remove_shoulders=False) == pytest.approx([0, 0], abs=1e-12)


def test_known_shapes():
    twin = -bump(LANE.wheel_center("left"), 0.5, 6) - bump(LANE.wheel_center("right"), 0.75, 6)
    left, right = depths(twin, remove_shoulders=False)
    assert left == pytest.approx(0.490893, abs=2e-5) and right == pytest.approx(0.736340, abs=3e-5)
    assert depths(0.0002 * (X - 81) ** 2, remove_shoulders=False) == pytest.approx([0.2473403452] * 2, abs=1e-9)
    assert depths(-bump(5, 0.8, 1), remove_shoulders=False)[0] == 0


def test_zone_edge_and_overhang():
    low = LANE.wheel_zone("left")[0]
    got = rut(Profile(X, -bump(low, 1.0, 0.5)), "left", LANE)
    assert got["rut_x"] == pytest.approx(low + 2)
    x = np.arange(100, 141.0)
    y = np.where(x <= 120, 1.0, 0.0) - bump(135, 1, 1, x)
    got = rut(Profile(x, y), "right", LANE)
    assert (got["left_contact_x"], got["right_contact_x"], got["depth"]) == (100, 120, 0)
    assert rut(Profile(x, y), "left", LANE) is None
    assert rut(Profile(X, 0 * X), "left", Lane(0, 162, wheel_offset=90)) is None
    with pytest.raises(ValueError):
        rut(Profile(X, 0 * X), "left", LANE, width=60)


def test_tilted_bar_settles():
    y = 0.9 * X - bump(46.55, 1.0, 6)
    got = rut(Profile(X, y), "left", LANE, hint=0.0)
    assert got["bar_slope"] == pytest.approx(0.9, abs=0.02) and got["right_contact_x"] - got["left_contact_x"] < 72 / math.sqrt(1 + 0.81) + 1


def test_support_line_is_the_highest_chord():
    rng = np.random.default_rng(0)
    for _ in range(300):
        x, y = np.sort(rng.uniform(0, 10, 25)), rng.normal(size=25)
        c = rng.uniform(x[0], x[-1])
        best = max(y[a] + (y[b] - y[a]) * (c - x[a]) / (x[b] - x[a]) for a in np.flatnonzero(x < c) for b in np.flatnonzero(x >= c))
        slope, height, i, j = support_line(x, y, c, rng.normal())
        assert height == pytest.approx(best, abs=1e-9) and (y <= height + slope * (x - c) + 1e-9).all() and x[i] <= c <= x[j]


def test_support_at_a_vertex_takes_the_hint():
    x, y = np.array([0.0, 1.0, 2.0]), np.array([0.0, 1.0, 0.0])
    assert support_line(x, y, 1.0, 0.3) == (0.3, 1.0, 1, 1)
    assert support_line(x, y, 1.0, 5.0) == (1.0, 1.0, 0, 1)
    assert support_line(x, y, 1.0, -5.0) == (-1.0, 1.0, 1, 2)
    assert support_line(x, -y, 1.0, 0.3) == (0.0, 0.0, 0, 2)


def test_footprint_against_a_dense_search():
    rng = np.random.default_rng(1)
    for _ in range(20):
        x = np.cumsum(rng.uniform(0.5, 1.5, 60))
        y = rng.normal(size=60)
        low, high = x[0] + 2, x[-1] - 2
        got = deepest_footprint(x, y, low, high, 4.0, 0.1, 3.0, 30.0)
        fine = np.linspace(x[0], x[-1], 200001)
        area = np.concatenate([[0], np.cumsum(np.diff(fine) * (np.interp(fine[1:], x, y) + np.interp(fine[:-1], x, y)) / 2)])
        c = np.linspace(low, high, 4001)
        gap = (3.0 + 0.1 * (c - 30) - (np.interp(c + 2, fine, area) - np.interp(c - 2, fine, area)) / 4) / math.sqrt(1.01)
        assert got[2] >= gap.max() - 1e-6 and got[2] == pytest.approx(gap.max(), abs=1e-3)
    with pytest.raises(ValueError):
        deepest_footprint(x, y, 5, 4, 4.0, 0, 0, 0)


def two_dips(more):
    """A flat surface with two dips of one form, the second one deeper by `more`."""
    x = np.arange(0, 60.01, 0.5)
    return x, -0.3 * np.maximum(0, 1 - np.abs(x - 15) / 3) - (0.3 + more) * np.maximum(0, 1 - np.abs(x - 45) / 3)


@pytest.mark.parametrize(("more", "at"), [(0.0, 15), (3e-10, 15), (-3e-10, 15), (3e-8, 45)])
def test_depths_equal_to_nine_places_are_equal(more, at):
    got = deepest_footprint(*two_dips(more), 2.0, 58.0, 4.0, 0.0, 0.0, 30.0)
    assert got[0] == pytest.approx(at, abs=1e-6) and got[2] == pytest.approx(0.2 + max(more, 0) * 2 / 3, abs=1e-14)


def test_cross_slope():
    x = np.arange(0, 162.01, 0.125)
    got = cross_slope(Profile(x, 7 + 0.02 * x), LANE)
    assert (got.percent, got.degrees, got.intercept, got.r2) == pytest.approx((-2, -1.145762838, 7, 1), abs=1e-8)
    both = cross_slope(Profile(np.array([1.0, 2, 3]), np.array([0.0, 9, 0])), Lane(0, 4), remove_shoulders=False)
    assert (both.percent, both.points) == (0, 3)
    lone = cross_slope(Profile(np.array([2.0]), np.array([9.0])), Lane(0, 4), remove_shoulders=False)
    assert math.isnan(lone.percent) and lone.points == 1
    with pytest.raises(ValueError):
        cross_slope(Profile(np.array([1.0, 1.5]), np.array([0.0, 1.0])), Lane(0, 4), remove_shoulders=False)
    assert cross_slope(Profile(x, 7 + 0.02 * x), LANE, positive_downward=False).percent == pytest.approx(2)


def steep(slopes, step=100.0):
    y = np.concatenate([[0], np.cumsum(np.asarray(slopes) * step)])
    return Profile(np.arange(len(y)) * step, y)


def test_shoulder_thresholds():
    lane = Lane(-1.0, 10_001.0)

    def cut(left, right=()):
        s = np.zeros(100)
        for k, v in left:
            s[k] = v
        for k, v in right:
            s[k] = v
        return shoulder_slice(steep(s), lane)

    run = [(k, 0.1) for k in range(5, 9)]
    assert cut([*run, (9, 0.17)]) == (11, 101)
    assert cut([*run, (9, 0.169999)])[0] == 0
    assert cut([*run[:3], (8, 0.17)])[0] == 0
    assert cut([*run, (9, 0.17), (10, 0.055)])[0] == 11 and cut([*run, (9, 0.17), (10, 0.055001)])[0] == 12
    assert cut([], [(k, 0.2) for k in range(90, 95)]) == (0, 90)
    assert cut([(k, 0.2) for k in (0, 1, 2, 3, 4)] + [(k, 0.2) for k in range(10, 15)])[0] == 16  # the innermost counts
    with pytest.raises(ValueError):
        without_shoulders(Profile(np.array([200.0, 201.0]), np.zeros(2)), LANE)
    with pytest.raises(ValueError):
        shoulder_slice(Profile(X, 0 * X), LANE, width=math.nan)


def test_lane_clip_is_open_and_one_point_is_only_clipped():
    p = Profile(np.array([0.0, 1.0, 162.0]), np.zeros(3))
    assert shoulder_slice(p, LANE) == (1, 2)
    assert shoulder_slice(Profile(np.array([5.0]), np.zeros(1)), LANE) == (0, 1)


def test_gaps():
    x, n = np.arange(7.0), math.nan
    y = np.array([n, 1, 2, n, 4, 5, n])
    got = reduce_profile(x, y, Reduction(crop_left=1, crop_right=6))
    assert got.x.tolist() == [1, 2, 3, 4, 5] and got.y.tolist() == [1, 2, 3, 4, 5] and got.valid_fraction == pytest.approx(4 / 6)
    assert reduce_profile(np.arange(6.0), np.array([0, 1, n, n, 4, 5]), Reduction(max_gap=2)).x.tolist() == [0, 1, 4, 5]
    assert reduce_profile(x, y, Reduction(invalid_policy="drop")).x.tolist() == [1, 2, 4, 5]
    for config in (Reduction(invalid_policy="raise"), Reduction(min_valid_fraction=0.9), Reduction(min_points=6)):
        with pytest.raises(ValueError):
            reduce_profile(x, y, config)
    assert fill_gaps(x, np.array([n, n, n, 1, n, n, n]))[3] == 1


def test_outliers_and_smoothing():
    x, y = np.arange(40.0), 0.1 * np.arange(40.0)
    y[10] = 100
    got = reduce_profile(x, y, Reduction(sigma=2, smooth_points=5, drop_last_window=True))
    assert len(got.x) == 39 - 5
    with pytest.raises(ValueError):
        reduce_profile(np.arange(5.0), np.arange(5.0), Reduction(smooth_points=7))


def test_noise():
    y = np.concatenate([np.tile([a, -a], 15) for a in (0.1, 0.2, 0.3)] + [np.full(5, 99.0)])
    assert batch_noise(y, 30) == pytest.approx(np.std([0.2, -0.2] * 15, ddof=1)) and batch_noise(y[:29], 30) == 0
    assert reduce_profile(np.arange(95.0), y, Reduction(noise_batch=30, max_noise=0.15)).is_noisy
    assert residual_noise(np.arange(50.0), np.arange(50.0), 5.0) == pytest.approx(0, abs=0.8) and residual_noise(np.arange(2.0), np.zeros(2), 2) == 0


def test_roll():
    x, y = roll(np.array([0.0, 1.0]), np.array([0.0, 0.0]), 90)
    assert x == pytest.approx([0, 0], abs=1e-12) and y == pytest.approx([0, -1])
    with pytest.raises(ValueError):
        roll(np.array([0.0, 1.0]), np.zeros(2), 1, reference=5)
    with pytest.raises(ValueError):  # x no longer rises
        reduce_profile(np.array([0.0, 0.1, 0.2]), np.array([0.0, 5.0, 0.0]), Reduction(roll_degrees=-60))


def test_errors_are_counted_where_they_belong():
    options, reduction = Options(), Reduction()
    out = measure(np.arange(200.0, 300.0), np.zeros(100), LANE, reduction, options)  # nothing inside the lane: both fail
    assert out["state"] == "error" and "cs_error" in out and "row_error" in out
    assert measure(np.array([1.0, 1.0]), np.zeros(2), LANE, reduction, options)["state"] == "error"
    half = measure(np.arange(90.0, 160.0), np.zeros(70), LANE, reduction, options)
    assert half["state"] == "ok" and "cs_error" in half and half["left"] is None and half["right"] is not None
    noisy = measure(X, np.tile([1.0, -1.0], len(X))[: len(X)], LANE, Reduction(noise_batch=30, max_noise=0.1), Options(skip_noisy=True))
    assert noisy["state"] == "skipped" and noisy["is_noisy"]
    assert slope_hint(Profile(np.array([1.0]), np.array([1.0])), LANE) == 0


def test_preview():
    img = height_image(np.array([[0, 1, 2], [3, 4, math.nan]]), 0, 100)
    assert img.ravel().tolist() == [0, 64, 128, 191, 255, 0]
    assert (height_image(np.full((2, 2), 7.0)) == 128).all()
    assert png(img)[:8] == b"\x89PNG\r\n\x1a\n"
    for bad in (np.zeros((0, 3)), np.full((2, 2), math.nan), np.zeros(3)):
        with pytest.raises(ValueError):
            height_image(bad)
