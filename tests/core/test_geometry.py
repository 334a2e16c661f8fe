"""Polygons by hand, and the predicates on pairs."""

import pytest
from pyspark.sql import functions as F

from roistack.functions import geometry as G
from roistack.operators.features import as_polygons
from roistack.operators.overlap import find_z_intersect

SQUARE = [(0, 0), (1, 0), (1, 1), (0, 1)]
C_SHAPE = [(0, 0), (5, 0), (5, 1), (1, 1), (1, 4), (5, 4), (5, 5), (0, 5)]


def rois(spark, shapes, name="p"):
    rows = [(name, roi, z, k * 1000 + i, float(x), float(y)) for k, (roi, z, ring) in enumerate(shapes) for i, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "name string, roi string, z int, ord long, x double, y double")


def moved(ring, dx, dy):
    return [(x + dx, y + dy) for x, y in ring]


def test_measures(spark):
    row = as_polygons(rois(spark, [("a", 1, SQUARE), ("c", 1, C_SHAPE), ("line", 1, [(0, 0), (1, 1)])])).select("roi", "area", G.perimeter(F.col("ring")).alias("per"), G.circularity(F.col("ring")).alias("circ"), G.centroid(F.col("ring")).alias("mid"), "xmin", "ymax")
    got = {r.roi: r for r in row.collect()}
    assert got["a"].area == 1 and got["a"].per == 4 and got["a"].circ == pytest.approx(0.785398, abs=1e-6)
    assert (got["a"].mid.x, got["a"].mid.y) == (0.5, 0.5) and (got["c"].xmin, got["c"].ymax) == (0, 5)
    assert got["c"].area == 13 and got["line"].area == 0 and got["line"].mid.x is None


CASES = {
    "shared edge": (moved(SQUARE, 1, 0), True, 0.0),
    "shared corner": (moved(SQUARE, 1, 1), True, 0.0),
    "same": (SQUARE, True, 1.0),
    "nested": ([(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)], True, 0.25),
    "half": (moved(SQUARE, 0.5, 0), True, 0.5),
    "apart": (moved(SQUARE, 3, 0), False, None),
    "clockwise": (moved(SQUARE, 0.5, 0.5)[::-1], True, 0.25),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("cell", [None, 0.4])
def test_pairs(spark, case, cell):
    ring, meets, shared = CASES[case]
    found = find_z_intersect(as_polygons(rois(spark, [("a", 1, SQUARE), ("b", 2, ring)])), cell=cell).collect()
    assert len(found) == int(meets)
    if meets:
        assert (found[0].roi_1, found[0].roi_2, found[0].z_dist) == ("b", "a", 1) and found[0].int_area == pytest.approx(shared)


def test_concave_without_contact(spark):
    inside = moved([(0, 0), (1, 0), (1, 1), (0, 1)], 2, 2)
    assert find_z_intersect(as_polygons(rois(spark, [("a", 1, C_SHAPE), ("b", 2, inside)]))).count() == 0


def test_slice_and_ratio_switches(spark):
    polygons = as_polygons(rois(spark, [("a", 1, SQUARE), ("b", 1, SQUARE), ("c", 3, SQUARE), ("flat", 2, [(0, 0), (1, 1), (0, 0)])]))
    assert {(r.roi_1, r.roi_2) for r in find_z_intersect(polygons, 2).collect()} == {("c", "a"), ("c", "b")}
    assert find_z_intersect(polygons, 1).count() == 0
    off = find_z_intersect(polygons, 0, None)
    assert "z1" not in off.columns and "int_ratio" not in off.columns
    assert {("a", "a"), ("b", "a"), ("c", "b"), ("flat", "c")} - {(r.roi_1, r.roi_2) for r in off.collect()} <= {("flat", "c")}


def exact_overlap(p, q):
    """Shared area of two simple rings in rational arithmetic: between all corners and crossings nothing changes order, so mid-slab lengths count."""
    from fractions import Fraction as Q

    sides = [[(a, b) for a, b in zip(r, r[1:] + r[:1], strict=True)] for r in (p, q)]
    stops = {Q(x) for r in (p, q) for x, _ in r}
    for (ax, ay), (bx, by) in sides[0]:
        for (cx, cy), (dx, dy) in sides[1]:
            cross = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if cross:
                t, u = Q((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx), cross), Q((cx - ax) * (by - ay) - (cy - ay) * (bx - ax), cross)
                if 0 <= t <= 1 and 0 <= u <= 1:
                    stops.add(ax + t * (bx - ax))
    total, stops = Q(0), sorted(stops)
    for lo, hi in zip(stops, stops[1:], strict=False):
        x, spans = (lo + hi) / 2, []
        for own in sides:
            ys = sorted(ay + Q(by - ay) * (x - ax) / (bx - ax) for (ax, ay), (bx, by) in own if min(ax, bx) < x < max(ax, bx))
            spans.append(list(zip(ys[::2], ys[1::2], strict=True)))
        total += (hi - lo) * sum((max(Q(0), min(b, d) - max(a, c)) for a, b in spans[0] for c, d in spans[1]), Q(0))
    return total


def test_concave_rings_against_exact_arithmetic(spark):
    import math
    import random

    rng = random.Random(11)

    def star():
        cx, cy, n = rng.randrange(12), rng.randrange(12), rng.randrange(5, 12)
        ring = [(cx + round(rng.choice((2, 9)) * math.cos(2 * math.pi * k / n)), cy + round(rng.choice((2, 9)) * math.sin(2 * math.pi * k / n))) for k in range(n)]
        return [a for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a != b][:: rng.choice((1, -1))]

    def simple(ring):
        """No two sides that aren't neighbours meet, and neighbours only at their corner."""
        def turn(a, b, c):
            return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        n = len(ring)
        for i in range(n):
            for j in range(i + 1, n):
                a, b, c, d = ring[i], ring[(i + 1) % n], ring[j], ring[(j + 1) % n]
                if (j - i) in (1, n - 1):
                    shared, x, y = (b, a, d) if j == i + 1 else (a, b, c)
                    if turn(x, shared, y) == 0:
                        return False
                elif turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0:
                    return False
        return n > 2

    made = []
    while len(made) < 60:
        ring = star()
        if simple(ring):
            made.append(ring)
    shapes = [(f"r{k}", 1 + k % 2, ring) for k, ring in enumerate(made)]
    found = {(r.roi_2, r.roi_1) if int(r.roi_2[1:]) < int(r.roi_1[1:]) else (r.roi_1, r.roi_2): r.int_area for r in find_z_intersect(as_polygons(rois(spark, shapes))).collect()}
    wanted = {(f"r{i}", f"r{j}"): exact_overlap(made[i], made[j]) for i in range(60) for j in range(i + 1, 60) if (i + j) % 2}
    assert sum(v > 0 for v in wanted.values()) > 200
    assert {k for k, v in wanted.items() if v > 0} <= set(found)
    assert all(abs(area - float(wanted[k])) < 1e-6 for k, area in found.items())
