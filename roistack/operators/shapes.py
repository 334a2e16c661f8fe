"""Shape measures of polygons, and ellipses fitted to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..plans.scratch import materialize


def shape_table(polygons: DataFrame) -> DataFrame:
    """``polygons`` (measured) with centroid, perimeter, circ, calipers, hull area, solidity, and the fitted ellipse's axes, aspect ratio and roundness.

    perimeter, hull and ellipse are those of the outline; area is without holes.
    """
    ring = F.col("ring")
    shaped = polygons.withColumns({"_hull": G.convex_hull(ring), "_fit": G.moment_ellipse(ring), "_mid": G.centroid(ring), "perimeter": G.perimeter(ring), "circ": G.circularity(ring)})
    shaped = shaped.withColumns({"_feret": G.feret(F.col("_hull")), "hull_area": G.area(F.col("_hull"))})
    return shaped.withColumns({
        "xc": F.col("_mid.x"), "yc": F.col("_mid.y"), "feret": F.col("_feret.feret"), "feret_angle": F.col("_feret.angle"), "feret_x": F.col("_feret.x"), "feret_y": F.col("_feret.y"), "min_feret": F.col("_feret.min_feret"),
        "solidity": F.try_divide("area", "hull_area"), "major": F.col("_fit.major"), "minor": F.col("_fit.minor"), "angle": F.col("_fit.angle"),
        "aspect_ratio": F.try_divide("_fit.major", "_fit.minor"), "roundness": F.try_divide("_fit.minor", "_fit.major"),
    }).drop("_hull", "_fit", "_mid", "_feret")


def add_ellipses(polygons: DataFrame, n: int = 64, suffix: str = "_ellipse") -> DataFrame:
    """``polygons`` and, after all of a position's own, for each the ellipse fitted to it as a ROI of ``n`` points, its name with ``suffix``.

    A ROI without area has none.
    """
    base = polygons.drop("area", "ori", "xmin", "ymin", "xmax", "ymax", "holes")
    # looked at three times: as they are, for the last one, and for their ellipses
    fitted = materialize(base.withColumn("_fit", G.moment_ellipse(F.col("ring"))), "fitted")
    base = fitted.drop("_fit")
    last = base.groupBy("name").agg((F.max("ord") + 1).alias("_after"))
    fitted = fitted.where("_fit IS NOT NULL").join(last, "name")
    fitted = fitted.withColumns({"ring": G.ellipse_ring(F.col("_fit"), n).cast(G.RING), "roi": F.concat("roi", F.lit(suffix)), "ord": F.col("ord") + F.col("_after")})
    return base.unionByName(fitted.select(*base.columns))
