"""From images to ROIs: masks of nuclei, nucleoli and cytoplasm, their particles as named ROIs, outline and measurement tables.

Each step is a table of the next: pixels, a mask, particles, outlines and
measurements.  Any number of images goes through at once.  Parameters have the
reference's names and values where it has any.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..plans.scratch import materialize
from . import raster as R
from .numbering import numbered

#: What masks, sizes and shapes of the reference's selections are; sizes are areas in physical units.
NUCLEUS = {"sigma": 8.0, "particle_size": (40.0, math.inf)}
NUCLEOLUS = {"sigma": 8.0, "particle_size": (3.0, 300.0), "particle_circularity": (0.5, 1.0)}
CYTOPLASM = {"sigma": 10.0, "level": 25.0, "highest": 65535.0, "trim": 500.0}
#: Vertices of a ROI that its place in a table's order leaves room for.
ROOM = 1 << 24


def _blurred(pixels: DataFrame, sigma: float, whole: bool) -> DataFrame:
    blurred = R.gaussian_blur(pixels, sigma)
    return blurred.withColumn("v", F.round("v")) if whole else blurred


def mask_nucleus(pixels: DataFrame, ch: int, sigma: float = NUCLEUS["sigma"], fill_hole: bool = True, z: int | None = None, whole: bool = True) -> DataFrame:
    """Blurred, above the threshold of least fuzziness of the whole stack (without its extremes), holes filled.

    ``whole``: values are whole numbers, so blurred ones are rounded.  ``z``: only that slice.
    """
    own = materialize(_blurred(R.select_channel(pixels, ch, z), sigma, whole), "blurred")
    mask = R.above_threshold(own, R.fuzzy_threshold(own, ignore_extremes=True))
    return R.fill_holes(materialize(mask, "mask")) if fill_hole else mask


def mask_nucleoli(pixels: DataFrame, ch: int, sigma: float = NUCLEOLUS["sigma"], whole: bool = True) -> DataFrame:
    """Inverted, blurred, above each slice's threshold of iterated means, closed."""
    own = materialize(_blurred(R.invert(R.select_channel(pixels, ch)), sigma, whole), "blurred")
    return R.close(materialize(R.above_threshold(own, R.auto_threshold(own, ("name", "ch", "z")), ("name", "ch", "z")), "mask"))


def mask_cytoplasm(pixels: DataFrame, ch: int, pixel_width: float, sigma: float = CYTOPLASM["sigma"], level: float = CYTOPLASM["level"], highest: float = CYTOPLASM["highest"], trim: float = CYTOPLASM["trim"]) -> DataFrame:
    """Blurred, between two levels, holes filled, without a margin of ``trim`` nanometres."""
    mask = materialize(R.threshold_mask(_blurred(R.select_channel(pixels, ch), sigma, False), level, highest), "mask")
    return R.trim(R.fill_holes(mask), trim, pixel_width)


def find_rois(mask: DataFrame, prefix: str = "", particle_size: tuple[float, float] = (0.0, math.inf), particle_circularity: tuple[float, float] = (0.0, math.inf), exclude_edges: bool = True, include_holes: bool = False, pixel_width: float = 1.0, suffix: str = "") -> DataFrame:
    """Pixels of the particles of a mask with roi and number, the ROI's place among its image's.

    A ROI's name is its slice, and the row and column of the middle of its box, four digits each; of several ROIs of
    one name those after the first have -1, -2 and so on.  ``particle_size`` is an area, ``pixel_width`` a pixel's side.
    """
    mask = R.fill_holes(mask) if include_holes else mask
    mask = materialize(mask, "mask")
    lo, hi = (s / (pixel_width * pixel_width) for s in particle_size)
    kept = R.particles(mask, lo, hi, exclude_edges, particle_circularity)
    part = lambda c: F.lpad(c.cast("int").cast("string"), 4, "0")
    middle = lambda a: F.floor(F.col(f"{a}min") + (F.col(f"{a}max") - F.col(f"{a}min") + 1) / 2)
    named = kept.withColumn("label", F.concat_ws("-", part(F.col("z")), part(middle("y")), part(middle("x"))))
    named = numbered(numbered(named, ["name"], ["z", "region"], "number"), ["name", "label"], ["number"], "same")
    again = F.when(F.col("same") > 1, F.concat(F.lit("-"), (F.col("same") - 1).cast("string"))).otherwise("")
    named = named.select("name", "z", "region", "number", "circ", F.concat(F.lit(prefix), "label", again, F.lit(suffix)).alias("roi"))
    return R.label_regions(mask).join(named, ["name", "z", "region"]).select("name", "z", "y", "x", "region", "roi", "number", "circ")


def outline_table(rois: DataFrame, pixel_width: float = 1.0, pixel_height: float | None = None) -> DataFrame:
    """name, roi, z, ord, x and y of the ROIs' outlines in physical units; y is scaled by the pixel's width too unless its height is given."""
    names = rois.select("name", "z", "region", "roi", "number").distinct()
    traced = R.outlines(rois.withColumn("ch", F.lit(1))).join(names, ["name", "z", "region"])
    height = pixel_width if pixel_height is None else pixel_height
    return traced.select("name", "roi", "z", (F.col("number") * ROOM + F.col("ord")).alias("ord"), G.physical(F.col("x"), pixel_width).alias("x"), G.physical(F.col("y"), height).alias("y"))


def measurement_table(pixels: DataFrame, rois: DataFrame, channels: list[int], pixel_width: float = 1.0) -> DataFrame:
    """name, roi, z, ch, label, area, circ, mean, min, max and stddev of each ROI in each of the listed channels."""
    own = pixels.where(F.col("ch").isin(channels))
    axes = pixels.groupBy("name").agg(F.max("ch").alias("_chs"), F.max("z").alias("_zs"))
    found = R.measure(own, rois).join(rois.select("name", "z", "region", "roi", "circ").distinct(), ["name", "z", "region"]).join(axes, "name")
    label = F.concat(F.concat_ws(":", "name", "roi", F.lit("c"), "ch"), F.lit("/"), "_chs", F.lit(" z:"), "z", F.lit("/"), "_zs")
    return found.select("name", "roi", "z", "ch", label.alias("label"), (F.col("area") * pixel_width * pixel_width).alias("area"), "circ", "mean", "min", "max", "stddev")


def select_nuclei(pixels: DataFrame, ch: int, channels: list[int], pixel_width: float = 1.0, sigma: float = NUCLEUS["sigma"], particle_size: tuple[float, float] = NUCLEUS["particle_size"], fill_hole: bool = True, z: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Outlines and measurements of the nuclei of a channel: no particles at the border, holes included."""
    rois = materialize(find_rois(mask_nucleus(pixels, ch, sigma, fill_hole, z), "nucleus_", particle_size, exclude_edges=True, include_holes=True, pixel_width=pixel_width), "rois")
    return outline_table(rois, pixel_width), measurement_table(pixels, rois, channels, pixel_width)


def select_nucleoli(pixels: DataFrame, ch: int, channels: list[int], pixel_width: float = 1.0, sigma: float = NUCLEOLUS["sigma"], particle_size: tuple[float, float] = NUCLEOLUS["particle_size"], particle_circularity: tuple[float, float] = NUCLEOLUS["particle_circularity"]) -> tuple[DataFrame, DataFrame]:
    """Outlines and measurements of the nucleoli, dark in a channel: no particles at the border."""
    rois = materialize(find_rois(mask_nucleoli(pixels, ch, sigma), "nucleolus_", particle_size, particle_circularity, pixel_width=pixel_width), "rois")
    return outline_table(rois, pixel_width), measurement_table(pixels, rois, channels, pixel_width)


def filled_polygons(polygons: DataFrame, pixel_width: float = 1.0, pixel_height: float | None = None) -> DataFrame:
    """Pixels (name, z, y, x, roi) whose middle lies in a polygon, holes left out, by rows of pixels.

    On a row a polygon's edges cross at an even number of places; pixels between each first and second one are inside.
    """
    height = pixel_width if pixel_height is None else pixel_height
    rows = polygons.withColumn("_rings", G.all_rings(polygons)).select("name", "z", "roi", "_rings", F.explode(F.sequence(F.floor(F.col("ymin") / height), F.floor(F.col("ymax") / height))).alias("y"))
    at = (F.col("y") + 0.5) * height

    def crossed(e):
        """Where an edge crosses the row, in pixels."""
        return (e["x1"] + (at - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])) / pixel_width

    edges = F.flatten(F.transform("_rings", G.edges))
    met = rows.withColumn("_at", F.array_sort(F.transform(F.filter(edges, lambda e: (e["y1"] > at) != (e["y2"] > at)), crossed)))
    spans = met.where(F.size("_at") > 1).select("name", "z", "roi", "y", F.explode(F.transform(F.sequence(F.lit(0), F.size("_at") - 2, F.lit(2)), lambda k: F.struct(F.ceil(F.get("_at", k) - 0.5).alias("a"), (F.ceil(F.get("_at", k + 1) - 0.5) - 1).alias("b")))).alias("s"))
    inside = spans.where("s.a <= s.b").select("name", "z", "y", F.explode(F.sequence("s.a", "s.b")).alias("x"), "roi")
    return inside.withColumns({c: F.col(c).cast("int") for c in "xy"})


def measure_selections(pixels: DataFrame, polygons: DataFrame, channels: list[int] | None = None, pixel_width: float = 1.0) -> DataFrame:
    """For each polygon and each channel: pixels, mean, smallest, largest and standard deviation of the values inside."""
    inside = filled_polygons(polygons, pixel_width)
    own = pixels if channels is None else pixels.where(F.col("ch").isin(channels))
    return own.join(inside, ["name", "z", "y", "x"]).groupBy("name", "z", "roi", "ch").agg(
        F.count("*").alias("area"), F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"), F.stddev_samp("v").alias("stddev"),
    )
