"""Calipers, ellipses, holes, long outlines, thresholds and distance maps against brute force."""

import math
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roistack.functions import geometry as G
from roistack.functions.edge_pairs import Edges, compare
from roistack.operators import raster as R
from roistack.operators.features import as_polygons, define_feature_group
from roistack.operators.overlap import find_z_intersect, measured
from roistack.operators.shapes import add_ellipses, shape_table

from .test_geometry import C_SHAPE, SQUARE, exact_overlap, moved, rois
from .test_tables import grid, shown


def hull_of(points):
    """Sides of the hull are pairs with all other points to the left or between them."""
    points = sorted(set(points))
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    between = lambda a, b, c: (c[0] - a[0]) * (c[0] - b[0]) + (c[1] - a[1]) * (c[1] - b[1]) <= 0
    return [(a, b) for a in points for b in points if a != b and all(turn(a, b, c) > 0 or (turn(a, b, c) == 0 and between(a, b, c)) for c in points)]


def test_hull_and_calipers(spark):
    rng = random.Random(4)
    rings = [[(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(rng.randint(1, 14))] for _ in range(60)] + [C_SHAPE, SQUARE, [(0, 0), (2, 2), (1, 1)], [(3, 3)], [(1, 5), (1, 5), (1, 5)]]
    df = as_polygons(rois(spark, [(str(k), 1, ring) for k, ring in enumerate(rings)]))
    rows = {int(r.roi): r for r in shape_table(df).withColumn("hull", G.convex_hull(F.col("ring"))).collect()}
    for k, ring in enumerate(rings):
        r, points = rows[k], set(ring)
        sides = hull_of(ring) if len(points) > 1 else []
        flat = len(sides) <= 2
        assert {(p.x, p.y) for p in r.hull} == ({p for s in sides for p in s} if not flat else {min(points), max(points)} if len(points) <= 2 else {(p.x, p.y) for p in r.hull})
        if len(points) < 2:
            assert r.feret is None
            continue
        assert r.feret == pytest.approx(max(math.dist(a, b) for a, b in combinations(points, 2)))
        if flat:
            assert r.min_feret == pytest.approx(0) and r.hull_area == pytest.approx(0)
            continue
        width = min(max(abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])) / math.dist(a, b) for c in points) for a, b in sides)
        assert r.min_feret == pytest.approx(width) and r.hull_area == pytest.approx(sum(a[0] * b[1] - b[0] * a[1] for a, b in sides) / 2)
        assert 0 <= r.feret_angle < 180 and (r.feret_x, r.feret_y) in points
        t = math.radians(r.feret_angle)
        along = [x * math.cos(t) + y * math.sin(t) for x, y in points]
        assert max(along) - min(along) == pytest.approx(r.feret)
    assert rows[60].solidity == pytest.approx(13 / 25) and rows[61].solidity == 1


def oval(x, y, major, minor, degrees, n=720):
    t = math.radians(degrees)
    return [(x + major / 2 * math.cos(a) * math.cos(t) - minor / 2 * math.sin(a) * math.sin(t), y + major / 2 * math.cos(a) * math.sin(t) + minor / 2 * math.sin(a) * math.cos(t)) for a in (2 * math.pi * k / n for k in range(n))]


def test_ellipses(spark):
    cases = {"a": (5, 7, 10, 4, 30), "b": (1e6, -1e6, 8, 7, 150), "round": (0, 0, 6, 6, 0), "c": (3, 3, 9, 1, 90)}
    shapes = [(k, 1, oval(*c)) for k, c in cases.items()] + [("line", 1, [(0, 0), (1, 1)]), ("box", 1, [(0, 0), (4, 0), (4, 1), (0, 1)])]
    df = as_polygons(rois(spark, shapes))
    got = {r.roi: r.e for r in df.select("roi", G.moment_ellipse(F.col("ring")).alias("e")).collect()}
    for k, (x, y, major, minor, angle) in cases.items():
        assert (got[k].x, got[k].y, got[k].major, got[k].minor) == pytest.approx((x, y, major, minor), abs=1e-3)
        assert k == "round" or got[k].angle == pytest.approx(angle, abs=1e-2)
    assert got["line"] is None and got["box"].major / got["box"].minor == pytest.approx(4) and math.pi / 4 * got["box"].major * got["box"].minor == pytest.approx(4)
    both = add_ellipses(df, 90)
    rows = {r.roi: r for r in as_polygons(both).collect()}
    assert set(rows) == {*got, *(f"{k}_ellipse" for k in got if k != "line")}
    assert min(r.ord for k, r in rows.items() if k.endswith("_ellipse")) > max(r.ord for k, r in rows.items() if not k.endswith("_ellipse"))
    assert all(rows[f"{k}_ellipse"].area == pytest.approx(rows[k].area, rel=3e-3) for k in cases)
    # the added ROIs take part like any other
    assert define_feature_group(both, min_z_span=1, max_z_dist=0).count() == len(rows)


HOLED = [(0, 0, 0), (0, 6, 0), (0, 6, 6), (0, 0, 6), (1, 2, 2), (1, 4, 2), (1, 4, 4), (1, 2, 4)]


def test_holes(spark):
    """A square with a hole, walked either way, against squares in the hole, across its rim, around all, and one with a hole of its own."""
    others = {"in the hole": ([(0, 2.5, 2.5), (0, 3.5, 2.5), (0, 3.5, 3.5), (0, 2.5, 3.5)], None), "fills the hole": ([(0, 2, 2), (0, 4, 2), (0, 4, 4), (0, 2, 4)], 0.0), "across": ([(0, 1, 1), (0, 3, 1), (0, 3, 3), (0, 1, 3)], 3.0), "around": ([(0, -1, -1), (0, 7, -1), (0, 7, 7), (0, -1, 7)], 32.0), "same": (HOLED, 32.0), "shifted": ([(p, x + 1, y) for p, x, y in HOLED], 5 * 6 - (2 * 2 + 2 * 2 - 1 * 2))}
    for turned in (False, True):
        own = [p for p in HOLED if p[0] == 0] + [p for p in HOLED if p[0] == 1][:: -1 if turned else 1]
        rows = [("p", "a", 1, i, part, float(x), float(y)) for i, (part, x, y) in enumerate(own)]
        rows += [("p", k, 2, 100 * (n + 1) + i, part, float(x), float(y)) for n, (k, (ring, _)) in enumerate(others.items()) for i, (part, x, y) in enumerate(ring)]
        df = as_polygons(spark.createDataFrame(rows, "name string, roi string, z int, ord long, part int, x double, y double"))
        assert {r.roi: r.area for r in df.collect()}["a"] == 32 and {r.roi: len(r.holes) for r in df.collect()}["across"] == 0
        found = {r.roi_1: r.int_area for r in find_z_intersect(df).collect()}
        assert {k: found.get(k) for k in others} == {k: pytest.approx(v) if v is not None else None for k, (_, v) in others.items()}


def arrow(polygons):
    return pa.array([[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings] for rings in polygons], pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def test_long_outlines_in_slabs():
    """Slabs of a few edges give what one slab gives, and exact arithmetic confirms it; sliced batches, empty rings, rows without overlap."""
    rng = random.Random(6)

    def star(n, cx, cy, size):
        return [(cx + size * (0.4 + 0.6 * rng.random()) * math.cos(2 * math.pi * k / n), cy + size * (0.4 + 0.6 * rng.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]

    left = [[star(rng.choice((5, 60, 400)), rng.random() * 4, rng.random() * 4, 3)] for _ in range(60)] + [[[]], [SQUARE], [], [SQUARE]]
    right = [[star(rng.choice((5, 60, 400)), rng.random() * 4, rng.random() * 4, 3)] for _ in range(60)] + [[SQUARE], [moved(SQUARE, 1, 0)], [SQUARE], [moved(SQUARE, 5, 5)]]
    one, two = arrow(left), arrow(right)
    whole = compare(Edges(one), Edges(two), 10**9)
    for slab in (3, 24):
        meet, area = compare(Edges(one), Edges(two), slab)
        assert (meet == whole[0]).all() and np.allclose(area, whole[1], atol=1e-9)
    assert whole[0][60:].tolist() == [False, True, False, False] and whole[0][:60].sum() > 40
    part = compare(Edges(one.slice(7, 20)), Edges(two.slice(7, 20)), 5)
    assert (part[0] == whole[0][7:27]).all() and np.allclose(part[1], whole[1][7:27], atol=1e-9)
    small = [k for k in range(60) if len(left[k][0]) == 5 and len(right[k][0]) == 5]
    grids = [([(round(x * 8), round(y * 8)) for x, y in left[k][0]], [(round(x * 8), round(y * 8)) for x, y in right[k][0]]) for k in small]
    areas = compare(Edges(arrow([[a] for a, _ in grids])), Edges(arrow([[b] for _, b in grids])), 2)[1]
    assert all(abs(v - float(exact_overlap(a, b))) < 1e-9 for v, (a, b) in zip(areas, grids, strict=True))


def fuzziest(values, bins, rounded=True):
    """Every split of the histogram, in plain Python."""
    lo, hi = min(values), max(values)
    step = 1.0 if all(v == int(v) for v in values) and hi - lo < bins else (hi - lo) / bins
    level = {v: min(int((v - lo) / step), bins - 1) if hi > lo else 0 for v in values}
    counts = {}
    for v in values:
        counts[level[v]] = counts.get(level[v], 0) + 1
    span, best = max(counts) - min(counts), None
    for t in sorted(counts)[:-1]:
        total = 0.0
        means = []
        for side in ([g for g in counts if g <= t], [g for g in counts if g > t]):
            m = sum(g * counts[g] for g in side) / sum(counts[g] for g in side)
            means.append(math.floor(m + 0.5) if rounded else m)
        for g, n in counts.items():
            u = 1 / (1 + abs(g - means[g > t]) / span)
            total += n * (-u * math.log(u) - (1 - u) * math.log(1 - u)) if u < 1 else 0
        total = round(total / len(values), 9)
        if best is None or total < best[0]:
            best = (total, max(v for v in values if level[v] <= t))
    return best and best[1]


def test_fuzzy_threshold(spark):
    rng = random.Random(8)
    stacks = {
        "two": [rng.choice((20, 21, 22, 200, 203)) for _ in range(300)], "wide": [rng.gauss(100, 20) for _ in range(200)] + [rng.gauss(900, 90) for _ in range(80)], "deep": [rng.randint(0, 60_000) for _ in range(300)],
        "flat": [7] * 20, "skewed": [min(255, int(rng.expovariate(0.03))) for _ in range(400)],
    }
    rows = [(k, 1, 1, 0, x, float(v)) for k, values in stacks.items() for x, v in enumerate(values)]
    pixels = spark.createDataFrame(rows, "name string, ch int, z int, y int, x int, v double")
    for rounded in (True, False):
        got = {r["name"]: r.threshold for r in R.fuzzy_threshold(pixels, whole_means=rounded).collect()}
        assert got == {k: fuzziest([float(v) for v in values], 256, rounded) for k, values in stacks.items() if k != "flat"}
    inner = [v for v in stacks["skewed"] if min(stacks["skewed"]) < v < max(stacks["skewed"])]
    got = {r["name"]: r.threshold for r in R.fuzzy_threshold(pixels.where("name = 'skewed'"), ignore_extremes=True).collect()}
    lo = min(stacks["skewed"])
    assert got["skewed"] == fuzziest([v - lo for v in map(float, inner)], 256) + lo
    assert {r.v for r in R.above_threshold(pixels, R.fuzzy_threshold(pixels)).where("on AND name = 'two'").collect()} == {200, 203}
    assert R.above_threshold(pixels, R.fuzzy_threshold(pixels)).where("on AND name = 'flat'").count() == 0


def test_distance_map(spark):
    rng = random.Random(12)
    pictures = [["".join(rng.choice("####.") for _ in range(9)) for _ in range(7)] for _ in range(2)] + [["###", "###"], ["#"]]
    frames = [grid(spark, p).withColumn("name", F.lit(str(k))) for k, p in enumerate(pictures)]
    mask = frames[0]
    for f in frames[1:]:
        mask = mask.union(f)
    far = {"chessboard": lambda a, b: max(a, b), "cityblock": lambda a, b: a + b, "euclidean": math.hypot}
    for metric, d in far.items():
        for border in (False, True):
            got = {(r["name"], r.y, r.x): r.distance for r in R.distance_map(mask, metric, border).collect()}
            for k, picture in enumerate(pictures):
                on = {(y, x): c == "#" for y, line in enumerate(picture) for x, c in enumerate(line)}
                off = [p for p, c in on.items() if not c]
                if border:
                    off += [(y, x) for y in range(-1, len(picture) + 1) for x in range(-1, len(picture[0]) + 1) if (y, x) not in on]
                for (y, x), c in on.items():
                    expected = 0 if not c else min((d(abs(y - b), abs(x - a)) for b, a in off), default=None)
                    assert got[str(k), y, x] == pytest.approx(expected), (metric, border, k, y, x)


def test_trim_is_as_many_erosions(spark):
    mask = grid(spark, ["##########"] * 4 + ["###.######"] + ["##########"] * 4)
    once = R.erode(mask)
    assert shown(R.trim(mask, 500, 0.5)) == shown(once) and shown(R.trim(mask, 500, 0.25)) == shown(R.erode(once))
    assert R.trim(mask, 100, 0.25) is mask


def test_rings_of_regions(spark):
    picture = ["#####.####", "#...#.#.##", "#.#.#.##.#", "#...#.####", "#####.....", ".....###.."]
    rings = R.outline_rings(R.label_regions(grid(spark, picture)))
    regions = as_polygons(rings.withColumn("roi", F.col("region").cast("string"))).collect()
    # background that touches at a corner only is one hole, pixels that do are two regions
    assert sorted((r.area, [len(h) for h in r.holes]) for r in regions) == [(1, []), (3, []), (14, [8]), (16, [12])]
    assert R.outlines(R.label_regions(grid(spark, picture))).count() == 4 + 8 + 16 + 20


def test_polygons_are_worked_out_once(spark, tmp_path):
    """Ellipses and the curve look at their polygons several times, and read a table then."""
    from roistack.sources.tables import read_polygons, write_polygons

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    rings = spark.createDataFrame([("p", f"r{i}", 1, i, [(x + i, y) for x, y in square]) for i in range(20)], f"name string, roi string, z int, ord long, ring {G.RING}")
    polygons = rings.mapInArrow(counted, rings.schema)
    assert add_ellipses(polygons, 8).count() == 40
    assert seen.value == 20
    write_polygons(measured(polygons), str(tmp_path / "polygons"))
    assert seen.value == 40
    assert read_polygons(spark, str(tmp_path / "polygons")).count() == 20
