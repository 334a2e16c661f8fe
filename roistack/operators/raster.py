"""Raster operators on pixel tables: name, ch, z, y, x and v, one row for each pixel.

Neighbourhoods are windows along an axis or generated offsets that are summed
again by key; particles are connected components of pixels.  What image tools
leave to their own algorithms is defined here and named in the docstrings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import connected_components

SLICE = ["name", "ch", "z"]
#: Columns that tell a pixel within a slice: rows of at most so many pixels.
WIDTH = 1 << 20


def select_channel(pixels: DataFrame, ch: int, z: int | None = None) -> DataFrame:
    """One channel, or one slice of it."""
    own = pixels.where(F.col("ch") == ch)
    return own if z is None else own.where(F.col("z") == z)


def gaussian_blur(pixels: DataFrame, sigma: float) -> DataFrame:
    """Separable blur with weights cut off at three sigma and scaled to the pixels that are there."""
    reach = max(1, math.ceil(3 * sigma))
    weights = {d: math.exp(-d * d / (2 * sigma * sigma)) for d in range(-reach, reach + 1)}
    for line, along in (("y", "x"), ("x", "y")):
        own = Window.partitionBy(*SLICE, line).orderBy(along)
        at = lambda c, d, own=own: F.lag(c, -d).over(own)
        near = {d: F.coalesce(at(along, d) == F.col(along) + d, F.lit(False)) for d in weights}
        total = sum((F.when(near[d], F.lit(w)).otherwise(0.0) for d, w in weights.items()), F.lit(0.0))
        value = sum((F.when(near[d], at("v", d) * w).otherwise(0.0) for d, w in weights.items()), F.lit(0.0))
        pixels = pixels.withColumn("v", value / total)
    return pixels


def invert(pixels: DataFrame, largest: float | None = None) -> DataFrame:
    """The largest value, of the slice unless given, minus each value."""
    top = F.max("v").over(Window.partitionBy(*SLICE)) if largest is None else F.lit(float(largest))
    return pixels.withColumn("v", top - F.col("v"))


def threshold_mask(pixels: DataFrame, lo: float, hi: float = math.inf) -> DataFrame:
    return pixels.withColumn("on", F.col("v").between(lo, hi))


def auto_threshold(pixels: DataFrame, by: tuple[str, ...] = ("name", "ch"), ignore_extremes: bool = False) -> DataFrame:
    """Threshold per stack (or, ``by`` with z, per slice) by iterated means, the inter-means rule of Ridler and Calvard (1978).

    The value that splits a histogram so that it is the middle of the means below and above: the smallest such
    level.  ``ignore_extremes`` leaves the smallest and the largest value out.  Works on counts of distinct values.
    """
    counts = pixels.groupBy(*by, "v").agg(F.count("*").alias("n"))
    own = Window.partitionBy(*by)
    if ignore_extremes:
        counts = counts.withColumns({"_lo": F.min("v").over(own), "_hi": F.max("v").over(own)}).where("v > _lo AND v < _hi").drop("_lo", "_hi")
    up = own.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.withColumns({
        "n_below": F.sum("n").over(up), "s_below": F.sum(F.col("n") * F.col("v")).over(up), "n_all": F.sum("n").over(own), "s_all": F.sum(F.col("n") * F.col("v")).over(own), "next": F.lead("v").over(own.orderBy("v")),
    })
    middle = (F.col("s_below") / F.col("n_below") + F.try_divide(F.col("s_all") - F.col("s_below"), F.col("n_all") - F.col("n_below"))) / 2
    return sums.withColumn("middle", middle).where("middle < next").groupBy(*by).agg(F.min_by("middle", "v").alias("threshold"))


def histogram_levels(pixels: DataFrame, by: tuple[str, ...], bins: int, ignore_extremes: bool = False) -> DataFrame:
    """level, n and top (the largest value) of each filled level of a stack's histogram.

    Whole values that span fewer than ``bins`` are levels themselves, counted from the smallest one; others fall into
    ``bins`` levels of equal width.  ``ignore_extremes`` leaves the smallest and the largest value out.
    """
    ends = pixels.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.bool_and(F.col("v") == F.floor("v")).alias("whole"))
    step = F.when(F.col("whole") & (F.col("hi") - F.col("lo") < bins), 1.0).otherwise((F.col("hi") - F.col("lo")) / bins)
    # one row for each value first, so that a stack's pixels are summed where they are
    counts = pixels.where("v IS NOT NULL").groupBy(*by, "v").agg(F.count("*").alias("n")).join(ends.withColumn("step", step), list(by))
    counts = counts.where("v > lo AND v < hi") if ignore_extremes else counts
    level = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / F.col("step")), F.lit(bins - 1))).otherwise(0)
    return counts.groupBy(*by, level.cast("int").alias("level")).agg(F.sum("n").alias("n"), F.max("v").alias("top"))


def fuzzy_threshold(pixels: DataFrame, by: tuple[str, ...] = ("name", "ch"), bins: int = 256, ignore_extremes: bool = False, whole_means: bool = True) -> DataFrame:
    """Threshold per stack (or, ``by`` with z, per slice) of least fuzziness, the rule of Huang and Wang (1995): pixels above it are on.

    A split of the histogram gives each level a membership of its side, 1 / (1 + distance to the side's mean / span),
    and an entropy -u ln u - (1 - u) ln (1 - u).  The split of smallest mean entropy wins, of equal ones the
    lowest.  ``whole_means``: means are rounded to whole levels, as the variant for 16-bit images does.  A stack with a
    single level has no threshold.  A histogram has at most ``bins`` levels, so a stack's splits are tried in a row.
    """
    own = Window.partitionBy(*by)
    up = own.orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    weight = F.col("n") * F.col("level")
    splits = histogram_levels(pixels, by, bins, ignore_extremes).withColumns({
        "n_below": F.sum("n").over(up), "s_below": F.sum(weight).over(up), "n_all": F.sum("n").over(own), "s_all": F.sum(weight).over(own),
        "span": (F.max("level").over(own) - F.min("level").over(own)).cast("double"), "levels": F.collect_list(F.struct("level", "n")).over(own),
    }).where("n_below < n_all")
    mean = lambda s, n: F.floor(s / n + 0.5) if whole_means else s / n
    splits = splits.withColumns({"below": mean(F.col("s_below"), F.col("n_below")), "above": mean(F.col("s_all") - F.col("s_below"), F.col("n_all") - F.col("n_below"))})

    def fuzziness(g: Column) -> Column:
        u = 1 / (1 + F.abs(g["level"] - F.when(g["level"] <= F.col("level"), F.col("below")).otherwise(F.col("above"))) / F.col("span"))
        return F.when(u < 1, g["n"] * (-u * F.ln(u) - (1 - u) * F.ln(1 - u))).otherwise(0.0)

    # rounded, so that the order of adding up can't decide between splits
    entropy = F.round(F.aggregate(F.transform("levels", fuzziness), F.lit(0.0), lambda total, e: total + e) / F.col("n_all"), 9)
    return splits.withColumn("entropy", entropy).groupBy(*by).agg(F.min_by("top", F.struct("entropy", "level")).alias("threshold"))


def above_threshold(pixels: DataFrame, thresholds: DataFrame, by: tuple[str, ...] = ("name", "ch")) -> DataFrame:
    """``on`` where a value is above its stack's threshold; off in a stack without one."""
    return pixels.join(thresholds.select(*by, "threshold"), list(by), "left").withColumn("on", F.coalesce(F.col("v") > F.col("threshold"), F.lit(False))).drop("threshold")


def _neighbourhood(mask: DataFrame, every: bool) -> DataFrame:
    """3 x 3 minimum (``every``) or maximum of ``on``; beyond the border there is nothing."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    spread = mask.select(*SLICE, "y", "x", "on", F.explode(steps).alias("d"))
    around = spread.groupBy(*SLICE, (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x")).agg((F.bool_and if every else F.bool_or)("on").alias("on"))
    return mask.drop("on").join(around, [*SLICE, "y", "x"])


def erode(mask: DataFrame) -> DataFrame:
    return _neighbourhood(mask, True)


def dilate(mask: DataFrame) -> DataFrame:
    return _neighbourhood(mask, False)


def close(mask: DataFrame) -> DataFrame:
    """Dilation, then erosion."""
    return erode(dilate(mask))


#: Metrics of a distance map: of steps along both axes.
METRICS = {"chessboard": np.maximum, "cityblock": np.add, "euclidean": np.hypot}


def distance_map(mask: DataFrame, metric: str = "euclidean", border: bool = False) -> DataFrame:
    """``mask`` with ``distance``, of each pixel to the nearest one of its slice that is off (0 for those); null where there is none.

    ``border``: what lies beyond the slice's border is off too.  Exact in two passes: windows along columns give the
    distance within a column; then, by lines, what columns k steps away offer is taken for k = 1, 2, ... until k alone
    is as far.  A line or a column is the most that a task holds together.
    """
    column = Window.partitionBy(*SLICE, "x").orderBy("y")
    off, edge = F.when(~F.col("on"), F.col("y")), Window.partitionBy(*SLICE)
    before = F.col("y") - F.last(off, ignorenulls=True).over(column.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(off, ignorenulls=True).over(column.rowsBetween(0, Window.unboundedFollowing)) - F.col("y")
    near = mask.withColumn("_near", F.least(before, after).cast("double"))
    ends = mask.groupBy(*SLICE).agg(F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1"))
    near = near.join(ends, SLICE)
    if border:
        near = near.withColumn("_near", F.least("_near", F.col("y") - F.col("_y0") + 1, F.col("_y1") + 1 - F.col("y")))
    lines = near.groupBy(*SLICE, "y").agg(F.array_sort(F.collect_list(F.struct("x", "_near"))).alias("_line"), F.first("_x0").alias("_x0"), F.first("_x1").alias("_x1"))
    lines = lines.select(*SLICE, "y", F.col("_line.x").alias("xs"), F.transform("_line._near", lambda v: F.coalesce(v, F.lit(math.inf))).alias("near"), "_x0", "_x1")
    combined = METRICS[metric]

    def farther(xs: np.ndarray, near: np.ndarray, x0: int, x1: int) -> np.ndarray:
        size = x1 - x0 + 1
        own = np.full(size, math.inf)
        own[xs - x0] = near
        best = own.copy()
        if border:
            at = np.arange(size)
            best = np.minimum(best, np.minimum(at + 1, size - at))
        k = 1
        while k < size and k < best.max():
            best[k:] = np.minimum(best[k:], combined(k, own[:-k]))
            best[:-k] = np.minimum(best[:-k], combined(k, own[k:]))
            k += 1
        return best[xs - x0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, near = batch.column(4), batch.column(5)
            x0, x1 = batch.column(6).to_pylist(), batch.column(7).to_pylist()
            for i in range(batch.num_rows):
                x = xs[i].values.to_numpy()
                found = farther(x, near[i].values.to_numpy(), x0[i], x1[i])
                row = [pa.array([batch.column(k)[i].as_py()] * len(x), batch.column(k).type) for k in range(4)]
                yield pa.RecordBatch.from_arrays([*row, pa.array(x), pa.array(found, mask=np.isinf(found))], names=[*SLICE, "y", "x", "distance"])

    kinds = dict(mask.dtypes)
    found = lines.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in (*SLICE, "y", "x")) + ", distance double")
    return mask.join(found, [*SLICE, "y", "x"])


def trim(mask: DataFrame, by: float, pixel_width: float) -> DataFrame:
    """``mask`` without a margin of ``by`` nanometres, the pixel's width being in micrometres: whole pixels, halves rounded up.

    The same as so many erosions, from one distance map.  Beyond the border there is nothing to erode from.
    """
    pixels = math.floor(by / pixel_width / 1000 + 0.5)
    if pixels <= 0:
        return mask
    far = distance_map(mask, "chessboard")
    return far.withColumn("on", F.col("on") & F.coalesce(F.col("distance") > pixels, F.lit(True))).drop("distance")


def _pixel_id() -> Column:
    return F.col("y").cast("long") * WIDTH + F.col("x")


def label_regions(mask: DataFrame, on: bool = True) -> DataFrame:
    """Pixels whose mask is ``on`` with ``region``, the smallest pixel id of their 4-connected region."""
    own = mask.where(F.col("on") == on).withColumn("id", _pixel_id()).withColumn("slice", F.concat_ws("|", *[F.col(c).cast("string") for c in SLICE]))
    steps = F.array(F.lit(1).cast("long"), F.lit(WIDTH).cast("long"))
    ahead = own.select("slice", F.col("id").alias("a"), F.explode(steps).alias("d")).withColumn("b", F.col("a") + F.col("d"))
    edges = ahead.join(own.select("slice", F.col("id").alias("b")), ["slice", "b"]).select(F.col("slice").alias("name"), "a", "b")
    found = connected_components(edges).select(F.col("name").alias("slice"), F.col("node").alias("id"), "component")
    return own.join(found, ["slice", "id"], "left").withColumn("region", F.coalesce("component", "id")).drop("component", "slice", "id")


def fill_holes(mask: DataFrame) -> DataFrame:
    """Background regions that don't touch the slice's border become foreground."""
    edge = mask.groupBy(*SLICE).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    holes = label_regions(mask, False).join(edge, SLICE)
    border = F.expr("x = x0 OR x = x1 OR y = y0 OR y = y1")
    outside = holes.groupBy(*SLICE, "region").agg(F.bool_or(border).alias("outside")).where("NOT outside")
    filled = holes.join(outside, [*SLICE, "region"], "left_semi").select(*SLICE, "y", "x", F.lit(True).alias("_hole"))
    return mask.join(filled, [*SLICE, "y", "x"], "left").withColumn("on", F.col("on") | F.coalesce("_hole", F.lit(False))).drop("_hole")


def particles(mask: DataFrame, min_size: float = 0, max_size: float = math.inf, exclude_edges: bool = False, circularity: tuple[float, float] = (0.0, math.inf), include_holes: bool = False) -> DataFrame:
    """name, ch, z, region, size, box and circ of the 4-connected regions whose size and circularity are in range.

    Circularity is 4 pi size / perimeter squared, the perimeter being the number of pixel sides that face outwards.
    """
    mask = fill_holes(mask) if include_holes else mask
    labelled = label_regions(mask)
    edge = mask.groupBy(*SLICE).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    own = labelled.select(*SLICE, "region", "y", "x")
    inner = own.select(*SLICE, "region", F.explode(steps).alias("d"), "y", "x").select(*SLICE, "region", (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x")).join(own, [*SLICE, "region", "y", "x"], "left_semi")
    facing = inner.groupBy(*SLICE, "region").agg(F.count("*").alias("inner_sides"))
    box = own.groupBy(*SLICE, "region").agg(F.count("*").alias("size"), F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"))
    found = box.join(facing, [*SLICE, "region"], "left").withColumn("perimeter", 4 * F.col("size") - F.coalesce("inner_sides", F.lit(0)))
    found = found.withColumn("circ", 4 * F.pi() * F.col("size") / (F.col("perimeter") * F.col("perimeter"))).drop("inner_sides")
    found = found.where(F.col("size").between(min_size, max_size) & F.col("circ").between(*circularity))
    if exclude_edges:
        found = found.join(edge, SLICE).where("xmin > x0 AND xmax < x1 AND ymin > y0 AND ymax < y1").drop("x0", "x1", "y0", "y1")
    return found


def _boundaries(cells: set[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The closed walks along the sides of a region's pixels, region to the left: its outline, then holes by their lowest corner."""
    sides: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x, y in cells:
        for (dx, dy), (a, b) in {(0, -1): ((x, y), (x + 1, y)), (1, 0): ((x + 1, y), (x + 1, y + 1)), (0, 1): ((x + 1, y + 1), (x, y + 1)), (-1, 0): ((x, y + 1), (x, y))}.items():
            if (x + dx, y + dy) not in cells:
                sides.setdefault(a, []).append(b)
    walks, left = [], {(a, b) for a, ends in sides.items() for b in ends}
    for a, b in sorted(left, key=lambda s: (s[0][1], s[0][0], s[1])):
        walk = []
        while (a, b) in left:
            left.discard((a, b))
            walk.append(a)
            # where two sides go on, the left turn stays on this region's own boundary
            a, b = b, max(sides[b], key=lambda c, a=a, b=b: (b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0]))
        if walk:
            walks.append(walk)
    return walks


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``name``, ``ch``, ``z``, ``region``, ``y``, ``x`` in order of the first four: the boundaries of each region."""

    def trace(regions: pa.Table) -> pa.RecordBatch:
        x, y = (regions.column(c).to_numpy().tolist() for c in ("x", "y"))
        cuts = [*_starts(regions).tolist(), len(x)]
        out: list[tuple[int, int, int, int, int]] = []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            walks = _boundaries(set(zip(x[i:j], y[i:j], strict=True)))
            corners = [(part, *corner) for part, walk in enumerate(walks) for corner in walk]
            out += [(i, part, at, a, b) for at, (part, a, b) in enumerate(corners)]
        row, part, at, a, b = (np.array(c, np.int64) for c in zip(*out, strict=True))
        own = regions.select(["name", "z", "region"]).take(pa.array(row)).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*own.columns, pa.array(part.astype(np.int32)), pa.array(at), pa.array(a.astype(np.float64)), pa.array(b.astype(np.float64))], names=["name", "z", "region", "part", "ord", "x", "y"])

    def _starts(regions: pa.Table) -> np.ndarray:
        new = np.zeros(len(regions), bool)
        new[0] = True
        for c in ("ch", "z", "region"):
            new[1:] |= np.diff(regions.column(c).to_numpy()) != 0
        names = pa.concat_arrays(regions.column("name").chunks).dictionary_encode().indices.fill_null(-1).to_numpy()
        new[1:] |= np.diff(names) != 0
        return np.flatnonzero(new)

    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        here = pa.Table.from_batches([batch])
        here = here if kept is None else pa.concat_tables([kept, here])
        # the last region may go on in the next batch
        last = int(_starts(here)[-1])
        if last:
            yield trace(here.slice(0, last))
        kept = here.slice(last)
    if kept is not None:
        yield trace(kept)


def outline_rings(labelled: DataFrame) -> DataFrame:
    """name, z, region, part, ord, x and y: all boundaries of each labelled region as the corners of its pixels' sides.

    Part 0 is the outline, walked counter-clockwise; further parts bound the region's holes and are walked clockwise.
    Rows as they are make polygons with holes: ``polygonize`` with a column ``roi``.  A region's pixels are gathered in
    one task; a region is one particle.
    """
    own = labelled.select("name", "ch", "z", "region", "y", "x").repartition("name", "ch", "z", "region").sortWithinPartitions("name", "ch", "z", "region")
    return own.mapInArrow(_traced, "name string, z int, region long, part int, ord long, x double, y double")


def outlines(labelled: DataFrame) -> DataFrame:
    """name, z, region, ord, x and y: the outline of each labelled region, without its holes."""
    return outline_rings(labelled).where("part = 0").drop("part")


def measure(pixels: DataFrame, labelled: DataFrame) -> DataFrame:
    """For each region of a mask and each channel: pixels, mean, smallest, largest and standard deviation of values."""
    where = labelled.select("name", "z", "y", "x", "region")
    return pixels.join(where, ["name", "z", "y", "x"]).groupBy("name", "z", "region", "ch").agg(
        F.count("*").alias("area"), F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"), F.stddev_samp("v").alias("stddev"),
    )
