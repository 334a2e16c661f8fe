"""Pairs of polygons compared edge by edge, for whole Arrow batches.

A polygon is a list of rings: the first is its outline, others bound its holes.
With holes walked the other way round than the outline, all its edges together
say what the polygon covers, so one signed sum over pairs of edges gives the
shared area of polygons with or without holes.

Only edges whose x ranges overlap meet or share area.  A pair of long outlines is
cut into vertical slabs, an index that lists every edge under the slabs it
crosses: edges meet within a slab, and count in the one slab where their overlap
begins.  A pair of short outlines is a single slab.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Pairs of edges that are looked at together.
CHUNK = 1 << 19
#: Edges of one polygon for each slab, about; outlines of fewer edges have one.
SLAB_EDGES = 24


class Edges:
    """The edges of each row's polygon, end to end; ``first`` has each row's first one."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        outer = _offsets(column)
        rings = column.values
        inner = _offsets(rings)
        points = rings.values
        x, y = (_doubles(points.field(k)) for k in (0, 1))
        size = np.diff(inner)
        ring_of = np.repeat(np.arange(len(size)), size)
        at = np.arange(inner[0], inner[0] + len(ring_of))
        ahead = np.where(at + 1 == inner[1:][ring_of], inner[:-1][ring_of], at + 1)
        begin = outer - outer[0]
        before = np.concatenate([[0], np.cumsum(size)])
        own = slice(int(before[outer[0]]), int(before[outer[-1]]))
        self.x1, self.y1, self.x2, self.y2 = x[at][own], y[at][own], x[ahead][own], y[ahead][own]
        self.first = before[outer] - before[outer[0]]
        self.row = np.repeat(np.arange(len(begin) - 1), np.diff(self.first))
        # holes turn against the outline
        cross = self.x1 * self.y2 - self.x2 * self.y1
        ring = ring_of[own]
        turn = np.zeros(len(size))
        np.add.at(turn, ring, cross)
        leading = np.zeros(len(size), bool)
        leading[outer[:-1][np.diff(outer) > 0]] = True
        lead = np.zeros(len(begin) - 1)
        lead[np.diff(outer) > 0] = np.sign(turn[outer[:-1][np.diff(outer) > 0]])
        flip = (~leading[ring]) & (np.sign(turn[ring]) == lead[self.row])
        self.x1, self.x2 = np.where(flip, self.x2, self.x1), np.where(flip, self.x1, self.x2)
        self.y1, self.y2 = np.where(flip, self.y2, self.y1), np.where(flip, self.y1, self.y2)
        self.ori = lead
        self.lo, self.hi = np.minimum(self.x1, self.x2), np.maximum(self.x1, self.x2)
        self.bottom = _least(np.minimum(self.y1, self.y2), self.first, np.inf)
        self.left, self.right = _least(self.lo, self.first, np.inf), -_least(-self.hi, self.first, np.inf)


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64) if len(column) else np.zeros(1, np.int64)


def _doubles(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _least(values: np.ndarray, first: np.ndarray, empty: float) -> np.ndarray:
    out = np.full(len(first) - 1, empty)
    some = np.diff(first) > 0
    if some.any():
        out[some] = np.minimum.reduceat(values, first[:-1][some])
    return out


def _inside(a: Edges, b: Edges) -> np.ndarray:
    """Whether the first point of each row's ``a`` lies in ``b``: a ray upwards crosses an odd number of edges."""
    have = np.diff(a.first) > 0
    px, py = (np.where(have, v[np.minimum(a.first[:-1], max(len(v) - 1, 0))] if len(v) else 0.0, np.nan) for v in (a.x1, a.y1))
    x, y = px[b.row], py[b.row]
    across = (b.x1 > x) != (b.x2 > x)
    wide = np.where(b.x2 == b.x1, 1.0, b.x2 - b.x1)
    above = (b.y1 + (b.y2 - b.y1) * (x - b.x1) / wide) > y
    return np.bincount(b.row[across & above], minlength=len(px)) % 2 == 1


def _listed(e: Edges, lo: np.ndarray, hi: np.ndarray, slabs: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edge and slab for each slab of its row that an edge crosses; edges beyond ``lo`` to ``hi`` of their row are left out."""
    own = np.flatnonzero((e.hi >= lo[e.row]) & (e.lo <= hi[e.row]))
    row = e.row[own]
    first, last = (slab_of(v[own], lo[row], hi[row], slabs[row]) for v in (e.lo, e.hi))
    many = last - first + 1
    edge = np.repeat(own, many)
    slab = np.repeat(base[row] + first - np.cumsum(many) + many, many) + np.arange(len(edge))
    return edge, slab


def slab_of(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, slabs: np.ndarray) -> np.ndarray:
    wide = np.where(hi > lo, hi - lo, 1.0)
    return np.clip(np.floor((x - lo) / wide * slabs), 0, slabs - 1).astype(np.int64)


def compare(a: Edges, b: Edges, slab_edges: int = SLAB_EDGES) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row's polygons intersect (boundaries count), and the area they share."""
    n = len(a.first) - 1
    lo, hi = np.maximum(a.left, b.left), np.minimum(a.right, b.right)
    slabs = np.maximum(1, np.maximum(np.diff(a.first), np.diff(b.first)) // slab_edges)
    slabs[~(hi > lo)] = 1
    base = np.cumsum(slabs) - slabs
    ea, sa = _listed(a, lo, hi, slabs, base)
    eb, sb = _listed(b, lo, hi, slabs, base)
    order = np.argsort(sb, kind="stable")
    eb, sb = eb[order], sb[order]
    start = np.searchsorted(sb, sa, "left")
    many = np.searchsorted(sb, sa, "right") - start
    sums = np.concatenate([[0], np.cumsum(many)])
    meet, area = np.zeros(n, bool), np.zeros(n)
    y0 = np.minimum(a.bottom, b.bottom)
    k = 0
    while k < len(ea):
        last = max(int(np.searchsorted(sums, sums[k] + CHUNK, "right")) - 1, k + 1)
        counts = many[k:last]
        one = np.repeat(np.arange(k, last), counts)
        two = start[one] + np.arange(len(one)) - np.repeat(sums[k:last] - sums[k], counts)
        slab, one, two = sa[one], ea[one], eb[two]
        k = last
        row = a.row[one]
        ahead = np.maximum(a.lo[one], b.lo[two])
        # the pair counts where its overlap begins
        own = (ahead <= np.minimum(a.hi[one], b.hi[two])) & (slab == base[row] + slab_of(np.maximum(ahead, lo[row]), lo[row], hi[row], slabs[row]))
        one, two, row = one[own], two[own], row[own]
        touched, below = _edges(*(v[one] for v in (a.x1, a.y1, a.x2, a.y2)), *(v[two] for v in (b.x1, b.y1, b.x2, b.y2)), y0[row])
        meet[row[touched]] = True
        area += np.bincount(row, below, n)
    return meet | _inside(a, b) | _inside(b, a), np.abs(area)


def _edges(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2, y0) -> tuple[np.ndarray, np.ndarray]:
    """Whether two edges have a point in common, and the signed area below both, above ``y0``."""
    side = lambda ox, oy, dx, dy, px, py: np.sign(dx * (py - oy) - dy * (px - ox))
    adx, ady, bdx, bdy = ax2 - ax1, ay2 - ay1, bx2 - bx1, by2 - by1
    meet = (np.maximum(ay1, ay2) >= np.minimum(by1, by2)) & (np.maximum(by1, by2) >= np.minimum(ay1, ay2)) & (np.maximum(ax1, ax2) >= np.minimum(bx1, bx2)) & (np.maximum(bx1, bx2) >= np.minimum(ax1, ax2))
    meet &= side(bx1, by1, bdx, bdy, ax1, ay1) * side(bx1, by1, bdx, bdy, ax2, ay2) <= 0
    meet &= side(ax1, ay1, adx, ady, bx1, by1) * side(ax1, ay1, adx, ady, bx2, by2) <= 0
    lo, hi = np.maximum(np.minimum(ax1, ax2), np.minimum(bx1, bx2)), np.minimum(np.maximum(ax1, ax2), np.maximum(bx1, bx2))
    height = lambda x1, y1, dx, dy, x: y1 + dy * (x - x1) / np.where(dx == 0, 1.0, dx) - y0
    a_lo, a_hi = height(ax1, ay1, adx, ady, lo), height(ax1, ay1, adx, ady, hi)
    b_lo, b_hi = height(bx1, by1, bdx, bdy, lo), height(bx1, by1, bdx, bdy, hi)
    d_lo, d_hi = a_lo - b_lo, a_hi - b_hi
    low, high = np.minimum(a_lo, b_lo), np.minimum(a_hi, b_hi)
    crossed = d_lo * d_hi < 0
    t = np.where(crossed, d_lo / np.where(crossed, d_lo - d_hi, 1.0), 0.0)
    middle = a_lo + t * (a_hi - a_lo)
    both = np.where(crossed, t * (low + middle) + (1 - t) * (middle + high), low + high)
    return meet, np.where(hi > lo, np.sign(adx) * np.sign(bdx) * (hi - lo) / 2 * both, 0.0)


def intersecting(keep: list[str], slab_edges: int = SLAB_EDGES):
    """For batches of ``keep`` columns, then rings_a and rings_b: rows that intersect, with int_area."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found, area = compare(Edges(batch.column(len(keep))), Edges(batch.column(len(keep) + 1)), slab_edges)
            which = pa.array(found)
            yield pa.RecordBatch.from_arrays([*[batch.column(k).filter(which) for k in range(len(keep))], pa.array(area[found])], names=[*keep, "int_area"])

    return run
