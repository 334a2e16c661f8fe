"""From images to ROIs, against the same steps in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roistack.operators import raster as R
from roistack.operators import selector as S
from roistack.operators.features import as_polygons
from roistack.plans import catalogue
from roistack.sources import fixtures as X

from .test_geometry import SQUARE, moved, rois
from .test_shapes import fuzziest
from .test_tables import grid

SF = "/root/testdata/sf0.001"


def flood(cells, start):
    found, todo = set(), [start]
    while todo:
        p = todo.pop()
        if p in cells and p not in found:
            found.add(p)
            todo += [(p[0] + dy, p[1] + dx) for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0))]
    return found


def regions(cells):
    left, out = set(cells), []
    while left:
        out.append(flood(left, min(left)))
        left -= out[-1]
    return out


def test_nuclei_by_hand(spark):
    images = {}
    for r in X.pixels(spark, SF).collect():
        images.setdefault(r["name"], {}).setdefault(r.ch, {})[r.y, r.x] = r.v
    expected, sigma, reach = {}, 1.5, 5
    weights = {d: math.exp(-d * d / (2 * sigma * sigma)) for d in range(-reach, reach + 1)}
    for name, image in images.items():
        height, width = 1 + max(y for y, _ in image[1]), 1 + max(x for _, x in image[1])
        v = np.array([[image[1][y, x] for x in range(width)] for y in range(height)])
        for axis, n in ((1, width), (0, height)):
            w = np.array([[weights.get(i - j, 0.0) for j in range(n)] for i in range(n)])
            w /= w.sum(axis=1, keepdims=True)
            v = v @ w.T if axis else w @ v
        v = np.where(v >= 0, np.floor(v + 0.5), np.ceil(v - 0.5))
        inner = [float(x) for x in v.ravel() if v.min() < x < v.max()]
        lo = v.min()
        # levels count from the smallest value of all
        assert v.max() - lo < 256
        threshold = fuzziest([x - lo for x in inner], 256) + lo
        on = {(y, x) for y in range(height) for x in range(width) if v[y, x] > threshold}
        off = {(y, x) for y in range(height) for x in range(width)} - on
        border = lambda cells, h=height, w=width: any(y in (0, h - 1) or x in (0, w - 1) for y, x in cells)
        for hole in regions(off):
            on |= set() if border(hole) else hole
        for cells in regions(on):
            if len(cells) >= 6 and not border(cells):
                ys, xs = [y for y, _ in cells], [x for _, x in cells]
                roi = f"nucleus_0001-{min(ys) + (max(ys) - min(ys) + 1) // 2:04d}-{min(xs) + (max(xs) - min(xs) + 1) // 2:04d}"
                for ch in (1, 2):
                    values = [image[ch][p] for p in cells]
                    expected[name, roi, ch] = (len(cells) / 16, round(sum(values) / len(values), 6), min(values), max(values))
    got = {(r["name"], r.roi, r.ch): (r.area, r.mean, r.min, r.max) for r in catalogue.select_nuclei(spark, SF).collect()}
    assert len(expected) > 10 and got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v, abs=2e-6) for k, v in expected.items())


def test_names_outlines_and_measurements(spark):
    picture = ["........", ".##..##.", ".##..##.", "........", "#.......", "##......"]
    mask = grid(spark, picture)
    found = S.find_rois(mask, "nucleus_", (1.0, 100.0), pixel_width=0.5)
    assert {(r.roi, r.number) for r in found.select("roi", "number").distinct().collect()} == {("nucleus_0001-0002-0002", 1), ("nucleus_0001-0002-0006", 2)}
    assert S.find_rois(mask, particle_size=(1.0, 100.0)).select("roi").distinct().count() == 2
    assert S.find_rois(mask, particle_size=(3.0, 3.0), exclude_edges=False).select("roi").distinct().collect() == [("0001-0005-0001",)]
    outline = S.outline_table(found, 0.5).orderBy("ord").collect()
    assert [(r.roi[-4:], r.z, r.x, r.y) for r in outline[:3]] == [("0002", 1, 0.5, 0.5), ("0002", 1, 1.0, 0.5), ("0002", 1, 1.5, 0.5)] and len(outline) == 16
    rows = S.measurement_table(mask.union(mask.withColumns({"ch": F.lit(2), "v": F.lit(7.0)})), found, [2], 0.5).collect()
    assert {(r.label, r.area, r.mean) for r in rows} == {(f"im:nucleus_0001-0002-000{x}:c:2/2 z:1/1", 1.0, 7.0) for x in (2, 6)}
    # two rings about one middle: the later one's name is told apart
    rings = ["#####", "#...#", "#.#.#", "#...#", "#####"]
    assert {r.roi for r in S.find_rois(grid(spark, rings), exclude_edges=False).select("roi").distinct().collect()} == {"0001-0002-0002", "0001-0002-0002-1"}
    assert S.find_rois(grid(spark, rings), exclude_edges=False, include_holes=True).count() == 25


def test_masks_of_nucleoli_and_cytoplasm(spark):
    rows = [("im", 1, z, y, x, 10.0 if (y - 10) ** 2 + (x - 10) ** 2 <= 9 else 200.0) for z in (1, 2) for y in range(21) for x in range(21)]
    pixels = spark.createDataFrame(rows, "name string, ch int, z int, y int, x int, v double")
    outlines, measured = S.select_nucleoli(pixels, 1, [1], sigma=1.0, particle_size=(5.0, 60.0))
    assert {(r.roi, r.z) for r in outlines.select("roi", "z").distinct().collect()} == {(f"nucleolus_000{z}-0010-0010", z) for z in (1, 2)}
    assert all(20 <= r.area <= 40 and r.circ >= 0.5 for r in measured.collect())
    bright = pixels.withColumn("v", F.lit(210.0) - F.col("v"))
    wide = S.mask_cytoplasm(bright, 1, 0.5, sigma=0.6, trim=0).where("on AND z = 1").count()
    assert wide - S.mask_cytoplasm(bright, 1, 0.5, sigma=0.6, trim=500).where("on AND z = 1").count() > 10


def test_selections_by_hand(spark):
    """A drawn polygon takes the pixels whose middles it holds; outlines give back their regions."""
    pixels = spark.createDataFrame([("p", ch, 1, y, x, float(10 * y + x) * ch) for ch in (1, 2) for y in range(6) for x in range(6)], "name string, ch int, z int, y int, x int, v double")
    drawn = as_polygons(rois(spark, [("a", 1, [(2 * x, 2 * y) for x, y in moved(SQUARE, 1.2, 1.2)]), ("b", 1, [(0.1, 0.1), (0.3, 0.1), (0.2, 0.3)]), ("c", 1, [(0, 0), (6, 0), (0, 6)])]))
    got = {(r.roi, r.ch): (r.area, r.mean) for r in S.measure_selections(pixels, drawn).collect()}
    assert {k: (n, pytest.approx(v)) for k, (n, v) in got.items()} == {("a", 1): (4, 27.5), ("a", 2): (4, 55.0), **{("c", ch): (15, ch * 44 / 3) for ch in (1, 2)}}
    picture = ["#######", "#.#...#", "#..#..#", "#######"]
    labelled = R.label_regions(grid(spark, picture))
    polygons = as_polygons(R.outline_rings(labelled).withColumn("roi", F.col("region").cast("string")))
    back = {(r.roi, r.y, r.x) for r in S.filled_polygons(polygons).collect()}
    assert back == {(str(r.region), r.y, r.x) for r in labelled.collect()}
    scaled = polygons.withColumn("ring", F.transform("ring", lambda p: F.struct((p["x"] * 0.25).alias("x"), (p["y"] * 0.25).alias("y")))).drop("holes")
    assert S.filled_polygons(as_polygons(scaled.drop("xmin", "xmax", "ymin", "ymax")), 0.25).where("roi = '0'").count() == 28
