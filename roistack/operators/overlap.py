"""Polygons that overlap: across slices of one set, or on the same slice of two sets.

Candidates come from an equi-join on position, slice and grid cell, with a test of
bounding boxes; a cell is larger than nearly all boxes and several slices deep, so most
polygons lie in one cell, and a set that meets itself is shuffled once.  The exact test compares the edges of whole
batches of candidate pairs where the join leaves them; nothing is shuffled for it.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.edge_pairs import intersecting

#: Decimal places to which ratios are rounded before they meet a threshold.
RATIO_PLACES = 9
#: Boxes side by side in a grid cell: with more, fewer polygons lie in several cells, and more pairs of a cell are told apart by their boxes.
CELL_BOXES = 3


def polygonize(vertices: DataFrame) -> DataFrame:
    """name, roi, z, ord, ring and further columns that are constant for a ROI, from vertex rows with x, y, z and ord.

    A ROI is a name in one position; one that is on several slices gives a row for each, with the ring of all its
    vertices.  Where vertices have a ``part``, those of part 0 are the outline and each other part bounds one of ``holes``.
    """
    vertices = vertices if "name" in vertices.columns else vertices.withColumn("name", F.lit(""))
    more = [c for c in vertices.columns if c not in ("name", "roi", "z", "ord", "x", "y", "idx", "include", "part")]
    flags = [F.bool_or("include").alias("include")] if "include" in vertices.columns else []
    parts = [F.coalesce("part", F.lit(0)).cast("int").alias("part")] if "part" in vertices.columns else []
    point = F.struct("ord", *parts, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rings = vertices.groupBy("name", "roi").agg(F.array_sort(F.collect_list(point)).alias("_p"), F.array_sort(F.collect_set("z")).alias("_z"), F.min("ord").alias("ord"), *[F.first(c).alias(c) for c in more], *flags)
    ring = lambda points: F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).cast(G.RING)
    if parts:
        numbers = F.array_distinct(F.transform(F.filter("_p", lambda p: p["part"] > 0), lambda p: p["part"]))
        rings = rings.withColumn("holes", F.transform(numbers, lambda k: ring(F.filter("_p", lambda p: p["part"] == k))))
        rings = rings.withColumn("_p", F.filter("_p", lambda p: p["part"] == 0))
    return rings.withColumn("ring", ring("_p")).withColumn("z", F.explode("_z")).drop("_p", "_z")


def roi_polygons(vertices: DataFrame, wanted: DataFrame, min_points: int = 1) -> DataFrame:
    """Polygons of the ROIs listed in ``wanted`` (roi, and name where vertices have it) that have ``min_points`` distinct vertices.

    Warns of ROIs that have fewer, or none, with the first of them; an error where none is left.  A vertex without a
    coordinate is none.
    """
    key = ["name", "roi"] if "name" in vertices.columns else ["roi"]
    listed = wanted.select(*key).distinct()
    found = polygonize(vertices.where("x IS NOT NULL AND y IS NOT NULL").join(listed, key, "left_semi"))
    fine = found.where(F.size(F.array_distinct("ring")) >= min_points)
    missing = [".".join(map(str, r)) for r in listed.join(fine, key, "left_anti").orderBy(*key).limit(6).collect()]
    if missing:
        warnings.warn(f"Some ROIs have no coordinates, or too few: {', '.join(missing[:5])}{', ...' if len(missing) > 5 else ''}", stacklevel=2)
        if fine.isEmpty():
            raise ValueError("No ROI of the list has coordinates")
    return fine


def measured(polygons: DataFrame) -> DataFrame:
    """Polygons with area (without that of holes), orientation and bounding box."""
    signed = polygons.withColumn("_signed", G.signed_area(F.col("ring")))
    return signed.withColumns({"area": G.without_holes(polygons, F.abs("_signed")), "ori": F.signum("_signed"), **G.bounds(F.col("ring"))}).drop("_signed")


def _placed(df: DataFrame, cell: float, extra: list[str], reach: int | None, slices: int | None) -> DataFrame:
    """What a comparison needs of each polygon, once for each cell that its box touches.

    With ``slices`` a cell is also so many slices deep, and a polygon lies in those of its own slice and of ``reach`` slices on.
    """
    span = lambda a: F.sequence(F.floor(F.col(f"{a}min") / cell), F.floor(F.col(f"{a}max") / cell))
    own = df.select("name", "roi", "z", "ord", "area", "xmin", "ymin", "xmax", "ymax", *extra, G.all_rings(df).alias("rings"))
    own = own.withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y")))
    depth = ["cz"] if slices else []
    if slices:
        own = own.withColumn("cz", F.explode(F.sequence(F.floor(F.col("z") / slices), F.floor((F.col("z") + reach) / slices))))
    # one long is sorted and compared much faster than a name and three places
    return own.withColumn("key", F.xxhash64("name", "cx", "cy", *depth))


def cell_size(*sides: DataFrame) -> float:
    """The side of grid cells: ``CELL_BOXES`` times what nine tenths of the boxes don't exceed, at least a hundredth of the longest one."""
    spans = [df.select(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")).alias("s")) for df in sides]
    each = [df.agg(F.percentile_approx("s", 0.9, 1000), F.max("s")).first() for df in spans]
    return max([1e-9, *(max(CELL_BOXES * q, most / 100) for q, most in each if q is not None)])


def _candidates(a: DataFrame, b: DataFrame, condition: Column, cell: float, slices: int | None = None) -> DataFrame:
    """Pairs of placed polygons whose boxes meet, each in the one cell that holds the lower left corner of what the boxes share, at the later slice."""
    a, b = (df.select(*[F.col(c).alias(f"{c}_{s}") for c in df.columns]) for df, s in ((a, "a"), (b, "b")))
    box = F.expr("xmax_a >= xmin_b AND xmax_b >= xmin_a AND ymax_a >= ymin_b AND ymax_b >= ymin_a")
    own = F.lit(True)
    # both sides say which cell is theirs: they then have the same columns, and a set that meets itself is shuffled once
    for s in "ab":
        own &= F.expr(f"cx_{s} = floor(greatest(xmin_a, xmin_b) / {cell!r}D) AND cy_{s} = floor(greatest(ymin_a, ymin_b) / {cell!r}D)")
        if slices:
            own &= F.expr(f"cz_{s} = floor(greatest(z_a, z_b) / {slices})")
    return a.join(b, (F.col("key_a") == F.col("key_b")) & condition & box & own)


def _compared(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """Of candidate pairs of sides a and b those that intersect, with the area they share."""
    pairs = pairs.select(*keep, "rings_a", "rings_b")
    found = pairs.mapInArrow(intersecting(keep), pairs.select(*keep).schema.add("int_area", "double"))
    # cells are told apart by hashes of a position and a place, of which the join has tested the place only
    return found.where(F.col("name_a").eqNullSafe(F.col("name_b")))


def _ratio() -> Column:
    return F.round(F.try_divide("int_area", F.least("area_a", "area_b")), RATIO_PLACES)


def find_z_intersect(polygons: DataFrame, max_z_dist: float | None = 1, min_intersect_ratio: float | None = 0.0, cell: float | None = None) -> DataFrame:
    """Pairs of one position's measured polygons that intersect across slices.

    roi_1 comes after roi_2 in order of appearance.  With ``0 < max_z_dist < inf`` only pairs at most so many slices
    apart, and not on one slice, remain; otherwise any pair does, each polygon with itself too.  With a ratio in
    [0, 1] only pairs that share so much of the smaller area remain, and the area columns are there.
    ``cell``: side of the grid's cells, from the boxes' sizes unless given.
    """
    by_z = max_z_dist is not None and 0 < max_z_dist < math.inf
    by_ratio = min_intersect_ratio is not None and 0 <= min_intersect_ratio <= 1
    reach = int(max_z_dist) if by_z else None
    slices = 4 * reach + 4 if by_z else None
    cell = cell or cell_size(polygons)
    placed = _placed(polygons, cell, [], reach, slices)
    condition = F.expr(f"ord_a > ord_b AND z_a <> z_b AND abs(z_a - z_b) <= {reach}") if by_z else F.expr("ord_a >= ord_b")
    keep = ["name_a", "name_b", "roi_a", "roi_b", "z_a", "z_b", "ord_a", "ord_b", "area_a", "area_b"]
    pairs = _compared(_candidates(placed, placed, condition, cell, slices), keep).withColumns({"min_area": F.least("area_a", "area_b"), "int_ratio": _ratio(), "z_dist": F.abs(F.col("z_a") - F.col("z_b"))})
    pairs = pairs.where(F.col("int_ratio") >= min_intersect_ratio) if by_ratio else pairs
    names = {"name_a": "name", "roi_a": "roi_1", "roi_b": "roi_2", "ord_a": "ord_1", "ord_b": "ord_2"} | ({"z_a": "z1", "z_b": "z2", "z_dist": "z_dist"} if by_z else {})
    names |= {"area_a": "area_1", "area_b": "area_2", "int_area": "int_area", "min_area": "min_area", "int_ratio": "int_ratio"} if by_ratio else {}
    return pairs.select(*[F.col(k).alias(v) for k, v in names.items()])


def same_slice_pairs(first: DataFrame, second: DataFrame, extra: list[str], cell: float | None = None) -> DataFrame:
    """Pairs of measured polygons of two sets that intersect on a slice: sides a and b with ``extra`` columns, int_area and int_ratio."""
    keep = [f"{c}_{s}" for c in ("name", "roi", "z", "ord", "area", *extra) for s in "ab"]
    cell = cell or cell_size(first, second)
    # a cell is one slice deep
    sides = [_placed(df, cell, extra, 0, 1) for df in (first, second)]
    return _compared(_candidates(*sides, F.expr("z_a = z_b"), cell, 1), keep).withColumn("int_ratio", _ratio())
