"""Planar polygon functions as column expressions.

A ring is an array of (x, y) points in outline order, not closed.  Areas come
from the shoelace sum.  A polygon's holes are rings beside its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"

def _next(ring: Column, i: Column) -> Column:
    return F.get(ring, (i + 1) % F.size(ring))


def edges(ring: Column) -> Column:
    """Array of (i, x1, y1, x2, y2), the last edge closing the ring."""
    at = F.sequence(F.lit(0), F.size(ring) - 1)
    return F.when(
        F.size(ring) > 0,
        F.transform(at, lambda i: F.struct(i.alias("i"), F.get(ring, i)["x"].alias("x1"), F.get(ring, i)["y"].alias("y1"), _next(ring, i)["x"].alias("x2"), _next(ring, i)["y"].alias("y2"))),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive for counter-clockwise rings; 0 for fewer than three points."""

    def added(total: Column, i: Column) -> Column:
        p, q = F.get(ring, i), _next(ring, i)
        return total + (p["x"] * q["y"] - q["x"] * p["y"])

    doubled = F.when(F.size(ring) > 0, F.aggregate(F.sequence(F.lit(0), F.size(ring) - 1), F.lit(0.0), added))
    return F.coalesce(doubled / 2, F.lit(0.0))


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def perimeter(ring: Column) -> Column:
    return F.coalesce(_sum(F.transform(edges(ring), lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]))), F.lit(0.0))


def circularity(ring: Column) -> Column:
    """4 pi area / perimeter squared; null for a ring without length."""
    return F.try_divide(4 * F.pi() * area(ring), perimeter(ring) * perimeter(ring))


def centroid(ring: Column) -> Column:
    """(x, y) of the area's centre; null for a ring without area."""
    cross = lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]
    x = _sum(F.transform(edges(ring), lambda e: (e["x1"] + e["x2"]) * cross(e)))
    y = _sum(F.transform(edges(ring), lambda e: (e["y1"] + e["y2"]) * cross(e)))
    six = 6 * signed_area(ring)
    return F.struct(F.try_divide(x, six).alias("x"), F.try_divide(y, six).alias("y"))


def ellipse(ring: Column) -> Column:
    """Best-fit ellipse of the vertices: centre, major and minor axis (4 standard deviations) and angle in degrees."""
    n = F.size(ring)
    mx, my = _sum(F.transform(ring, lambda p: p["x"])) / n, _sum(F.transform(ring, lambda p: p["y"])) / n
    xx = _sum(F.transform(ring, lambda p: (p["x"] - mx) * (p["x"] - mx))) / n
    yy = _sum(F.transform(ring, lambda p: (p["y"] - my) * (p["y"] - my))) / n
    xy = _sum(F.transform(ring, lambda p: (p["x"] - mx) * (p["y"] - my))) / n
    half, root = (xx + yy) / 2, F.sqrt((xx - yy) * (xx - yy) / 4 + xy * xy)
    return F.struct(
        mx.alias("x"), my.alias("y"), (4 * F.sqrt(half + root)).alias("major"), (4 * F.sqrt(F.greatest(half - root, F.lit(0.0)))).alias("minor"),
        F.degrees(F.atan2(2 * xy, xx - yy) / 2).alias("angle"),
    )


def all_rings(polygons: DataFrame) -> Column:
    """A polygon's ring and those of its holes, if the table has any."""
    own = F.array("ring")
    return F.concat(own, F.coalesce("holes", F.array().cast(f"array<{RING}>"))) if "holes" in polygons.columns else own


def area_of(polygons: DataFrame) -> Column:
    """The area of a polygon without its holes."""
    return without_holes(polygons, area(F.col("ring")))


def without_holes(polygons: DataFrame, whole: Column) -> Column:
    """``whole``, the area of a polygon's ring, without that of its holes, if the table has any."""
    return whole - _sum(F.transform(F.coalesce("holes", F.array().cast(f"array<{RING}>")), area)) if "holes" in polygons.columns else whole


def _let(value: Column, f) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _turn(o: Column, p: Column, q: Column) -> Column:
    """Positive where o, p and q turn to the left."""
    return (p["x"] - o["x"]) * (q["y"] - o["y"]) - (p["y"] - o["y"]) * (q["x"] - o["x"])


def convex_hull(ring: Column) -> Column:
    """The corners of a ring's convex hull, counter-clockwise from the leftmost; points on its sides are none.

    Chains grow over the points from left to right, and back: a point drops the corners that no longer turn to the
    left.  As a chain is convex, those that stay are its first ones, so they are counted rather than popped.
    """

    def chain(points: Column) -> Column:
        def grown(corners: Column, p: Column) -> Column:
            stay = F.filter(F.sequence(F.lit(2), F.size(corners)), lambda k: _turn(F.get(corners, k - 2), F.get(corners, k - 1), p) > 0)
            return F.when(F.size(corners) < 2, F.concat(corners, F.array(p))).otherwise(F.concat(F.slice(corners, 1, 1 + F.size(stay)), F.array(p)))

        return F.aggregate(points, F.array().cast(RING), grown)

    ends = lambda c: _let(c, lambda v: F.slice(v, 1, F.size(v) - 1))
    whole = lambda points: F.when(F.size(points) < 3, points).otherwise(F.concat(ends(chain(points)), ends(chain(F.reverse(points)))))
    return _let(F.array_sort(F.array_distinct(ring)), whole)


def feret(hull: Column) -> Column:
    """Calipers about a convex hull: the largest width, its angle in degrees from 0 to below 180 and where it begins, and the smallest width.

    The largest width lies between two corners (of equal ones the first by corner), the smallest across a side.
    """
    at = F.sequence(F.lit(0), F.size(hull) - 1)
    side = lambda i: F.struct(F.get(hull, i).alias("p"), _next(hull, i).alias("q"))
    apart = lambda p, q: (q["x"] - p["x"]) * (q["x"] - p["x"]) + (q["y"] - p["y"]) * (q["y"] - p["y"])
    farthest = F.array_max(F.flatten(F.transform(at, lambda i: F.transform(F.sequence(i, F.size(hull) - 1), lambda j: F.struct(apart(F.get(hull, i), F.get(hull, j)).alias("d"), (-i).alias("i"), (-j).alias("j"))))))
    across = F.transform(at, lambda i: _let(side(i), lambda s: F.array_max(F.transform(hull, lambda p: F.abs(_turn(s["p"], s["q"], p)))) / F.sqrt(apart(s["p"], s["q"]))))

    def caliper(most: Column) -> Column:
        one, two = F.get(hull, -most["i"]), F.get(hull, -most["j"])
        angle = F.pmod(F.degrees(F.atan2(two["y"] - one["y"], two["x"] - one["x"])), F.lit(180.0))
        return F.struct(F.sqrt(most["d"]).alias("feret"), angle.alias("angle"), one["x"].alias("x"), one["y"].alias("y"), F.when(F.size(hull) > 2, F.array_min(across)).otherwise(F.lit(0.0)).alias("min_feret"))

    return F.when(F.size(hull) >= 2, _let(farthest, caliper))


def moment_ellipse(ring: Column) -> Column:
    """The ellipse of a ring's area, centre and second moments: centre, major and minor axis, angle in degrees from 0 to below 180; null without area.

    Moments are taken about the first point, which keeps rings far from the origin exact.
    """
    names = ("a", "sx", "sy", "sxx", "syy", "sxy")

    def added(total: Column, e: Column) -> Column:
        def terms(v: Column) -> Column:
            x1, y1, x2, y2, c = v["x1"], v["y1"], v["x2"], v["y2"], v["c"]
            sums = (c, (x1 + x2) * c, (y1 + y2) * c, (x1 * x1 + x1 * x2 + x2 * x2) * c, (y1 * y1 + y1 * y2 + y2 * y2) * c, (x1 * y2 + 2 * x1 * y1 + 2 * x2 * y2 + x2 * y1) * c)
            return F.struct(*[(total[n] + t).alias(n) for n, t in zip(names, sums, strict=True)])

        return _let(e, terms)

    def fitted(s: Column) -> Column:
        size = s["a"] / 2
        mx, my = F.try_divide(s["sx"], 6 * size), F.try_divide(s["sy"], 6 * size)
        central = F.struct(mx.alias("x"), my.alias("y"), F.abs(size).alias("size"), (F.try_divide(s["sxx"], 12 * size) - mx * mx).alias("xx"), (F.try_divide(s["syy"], 12 * size) - my * my).alias("yy"), (F.try_divide(s["sxy"], 24 * size) - mx * my).alias("xy"))
        return F.when(size != 0, _let(central, axes))

    def axes(m: Column) -> Column:
        half, root = (m["xx"] + m["yy"]) / 2, F.sqrt((m["xx"] - m["yy"]) * (m["xx"] - m["yy"]) / 4 + m["xy"] * m["xy"])
        long, short = F.sqrt(half + root), F.sqrt(F.greatest(half - root, F.lit(0.0)))
        # axes of the moments' ratio whose ellipse has the ring's area
        scale = F.sqrt(F.try_divide(m["size"], F.pi() * long * short))
        angle = F.when(root > 1e-12 * half, F.pmod(F.degrees(F.atan2(2 * m["xy"], m["xx"] - m["yy"]) / 2), F.lit(180.0))).otherwise(0.0)
        o = F.get(ring, F.lit(0))
        return F.struct((o["x"] + m["x"]).alias("x"), (o["y"] + m["y"]).alias("y"), (2 * long * scale).alias("major"), (2 * short * scale).alias("minor"), angle.alias("angle"))

    def moved(i: Column) -> Column:
        o, p, q = F.get(ring, F.lit(0)), F.get(ring, i), _next(ring, i)
        x1, y1, x2, y2 = p["x"] - o["x"], p["y"] - o["y"], q["x"] - o["x"], q["y"] - o["y"]
        return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), (x1 * y2 - x2 * y1).alias("c"))

    steps = F.transform(F.sequence(F.lit(0), F.size(ring) - 1), moved)
    return F.when(F.size(ring) > 0, F.aggregate(steps, F.struct(*[F.lit(0.0).alias(n) for n in names]), added, fitted))


def ellipse_ring(ellipse: Column, n: int) -> Column:
    """``n`` points of an ellipse (x, y, major, minor, angle), counter-clockwise from the end of its major axis."""
    turn = F.radians(ellipse["angle"])

    def point(k: Column) -> Column:
        t = k * (2 * math.pi / n)
        along, aside = ellipse["major"] / 2 * F.cos(t), ellipse["minor"] / 2 * F.sin(t)
        return F.struct((ellipse["x"] + along * F.cos(turn) - aside * F.sin(turn)).alias("x"), (ellipse["y"] + along * F.sin(turn) + aside * F.cos(turn)).alias("y"))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)


def bounds(ring: Column) -> dict[str, Column]:
    """xmin, ymin, xmax and ymax."""
    xs, ys = ring.getField("x"), ring.getField("y")
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def physical(pixel: Column, pixel_size: float) -> Column:
    """Pixel to physical coordinate; y is scaled by the pixel's width too unless its height is given."""
    return pixel * F.lit(float(pixel_size))


def hilbert(x: Column, y: Column, bits: int = 16) -> Column:
    """The place of a cell of a grid of ``2 ** bits`` a side (whole numbers from 0) along Hilbert's curve: cells close on it are close in the plane.

    From the largest quadrants down, each takes its place in the curve's order, and is turned so that its own curve begins and ends where it should.
    """

    def step(s: Column, k: Column) -> Column:
        side = F.pow(F.lit(2.0), k).cast("long")

        def turned(q: Column) -> Column:
            rx, ry, low_x, low_y = q["rx"], q["ry"], q["x"] % side, q["y"] % side
            flip = (ry == 0) & (rx == 1)
            fx, fy = F.when(flip, side - 1 - low_x).otherwise(low_x), F.when(flip, side - 1 - low_y).otherwise(low_y)
            place = side * side * ((3 * rx).bitwiseXOR(ry))
            return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), (q["d"] + place).alias("d"))

        quadrant = F.struct((F.floor(s["x"] / side) % 2).alias("rx"), (F.floor(s["y"] / side) % 2).alias("ry"), s["x"].alias("x"), s["y"].alias("y"), s["d"].alias("d"))
        return _let(quadrant, turned)

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda s: s["d"])
