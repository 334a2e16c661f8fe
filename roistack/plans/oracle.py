"""The same queries in SQL, from the tables up."""

from __future__ import annotations

from ..sources.fixtures import MEASUREMENTS, NUCLEOLI, PIXELS, VERTICES

#: Edge (ax1, ay1)-(ax2, ay2) and edge (bx1, by1)-(bx2, by2) have a point in common.
EDGES_MEET = """(
 greatest(ax1, ax2) >= least(bx1, bx2) AND greatest(bx1, bx2) >= least(ax1, ax2)
 AND greatest(ay1, ay2) >= least(by1, by2) AND greatest(by1, by2) >= least(ay1, ay2)
 AND sign((bx2 - bx1) * (ay1 - by1) - (by2 - by1) * (ax1 - bx1)) * sign((bx2 - bx1) * (ay2 - by1) - (by2 - by1) * (ax2 - bx1)) <= 0
 AND sign((ax2 - ax1) * (by1 - ay1) - (ay2 - ay1) * (bx1 - ax1)) * sign((ax2 - ax1) * (by2 - ay1) - (ay2 - ay1) * (bx2 - ax1)) <= 0
)"""


def crosses(px: str, py: str, e: str) -> str:
    """A ray from the point to the right crosses the edge."""
    return f"(({e}y1 > {py}) <> ({e}y2 > {py}) AND {px} < ({e}x2 - {e}x1) * ({py} - {e}y1) / CASE WHEN {e}y2 = {e}y1 THEN 1.0 ELSE {e}y2 - {e}y1 END + {e}x1)"


_AT = "({e}y1 + ({e}y2 - {e}y1) * ({x} - {e}x1) / CASE WHEN {e}x2 = {e}x1 THEN 1.0 ELSE {e}x2 - {e}x1 END - y0)"
_LO, _HI = "greatest(least(ax1, ax2), least(bx1, bx2))", "least(greatest(ax1, ax2), greatest(bx1, bx2))"


def shared_area_term() -> str:
    """The signed area below both edges, above y0, where their x ranges overlap."""
    a_lo, a_hi, b_lo, b_hi = (_AT.format(e=e, x=x) for e in "ab" for x in (_LO, _HI))
    width = f"({_HI} - {_LO})"
    low, high = f"least({a_lo}, {b_lo})", f"least({a_hi}, {b_hi})"
    t = f"(({a_lo} - {b_lo}) / (({a_lo} - {b_lo}) - ({a_hi} - {b_hi})))"
    cross = f"({a_lo} + {t} * ({a_hi} - {a_lo}))"
    split = f"({t} * ({low} + {cross}) + (1 - {t}) * ({cross} + {high}))"
    below = f"CASE WHEN ({a_lo} - {b_lo}) * ({a_hi} - {b_hi}) < 0 THEN {split} ELSE {low} + {high} END"
    return f"CASE WHEN {width} > 0 THEN sign(ax2 - ax1) * sign(bx2 - bx1) * {width} / 2 * ({below}) ELSE 0.0 END"



def _tables(sql: str) -> str:
    return sql.format(orders="orders", lineitem="lineitem")


def with_vertices(select: str) -> str:
    return f"WITH v AS ({_tables(VERTICES)})\n{select}"


def measurements(select: str, vertices: bool = False) -> str:
    more = f", v AS ({_tables(VERTICES)})" if vertices else ""
    return f"WITH m AS ({_tables(MEASUREMENTS)}){more}\n{select}"


def _polygons(s: str, vertices: str) -> str:
    """CTEs {s}e of edges and {s}p of polygons."""
    return f"""{s}v AS ({_tables(vertices)}),
{s}e AS MATERIALIZED (
    SELECT *, x AS x1, y AS y1, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2,
           row_number() OVER w - 1 AS i FROM {s}v WINDOW w AS (PARTITION BY name, roi ORDER BY ord)
),
{s}p AS MATERIALIZED (
    SELECT name, roi, z, min(ord) AS ord, count(*) AS n, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax, {"bool_or(include)" if "include" in vertices else "true"} AS include,
           abs(sum(x1 * y2 - x2 * y1)) / 2 AS area, sign(sum(x1 * y2 - x2 * y1)) AS ori, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS per
    FROM {s}e GROUP BY name, roi, z
)"""


def polygons(select: str) -> str:
    return f"WITH {_polygons('', VERTICES)}\n{select}"


#: Boxes that meet, both in the one cell of 16 that holds the lower left corner of what they share.
BOX = "a.cx = b.cx AND a.cy = b.cy AND a.cx = floor(greatest(a.xmin, b.xmin) / 16) AND a.cy = floor(greatest(a.ymin, b.ymin) / 16) AND a.xmax >= b.xmin AND b.xmax >= a.xmin AND a.ymax >= b.ymin AND b.ymax >= a.ymin"


def _celled(table: str) -> str:
    span = lambda a: f"unnest(range(CAST(floor({a}min / 16) AS BIGINT), CAST(floor({a}max / 16) AS BIGINT) + 1)) AS c{a}"
    return f"(SELECT *, {span('y')} FROM (SELECT *, {span('x')} FROM {table}))"


def _compared(name: str, candidates: str, e_a: str, e_b: str) -> str:
    """CTE of the candidates, of names that are unique over all positions (roi_a, roi_b, area_a, area_b, oris, y0) that intersect."""
    return f"""{name}_c AS MATERIALIZED ({candidates}),
{name}_f AS (
    SELECT c.name, c.roi_a, c.roi_b, c.oris, c.y0, ea.i AS ia, eb.i AS ib, ea.x1 AS ax1, ea.y1 AS ay1, ea.x2 AS ax2, ea.y2 AS ay2, eb.x1 AS bx1, eb.y1 AS by1, eb.x2 AS bx2, eb.y2 AS by2
    FROM {name}_c c JOIN {e_a} ea ON ea.roi = c.roi_a JOIN {e_b} eb ON eb.roi = c.roi_b
),
{name}_s AS (
    SELECT name, roi_a, roi_b, bool_or({EDGES_MEET}) AS meet, sum((ia = 0 AND {crosses("ax1", "ay1", "b")})::INT) % 2 AS a_in_b, sum((ib = 0 AND {crosses("bx1", "by1", "a")})::INT) % 2 AS b_in_a,
           abs(any_value(oris) * sum({shared_area_term()})) AS int_area
    FROM {name}_f GROUP BY name, roi_a, roi_b
),
{name} AS (
    SELECT c.*, s.int_area, least(area_a, area_b) AS min_area, round(s.int_area / least(area_a, area_b), 9) AS int_ratio
    FROM {name}_s s JOIN {name}_c c USING (name, roi_a, roi_b) WHERE meet OR a_in_b = 1 OR b_in_a = 1
)"""


def _pairs(s: str, max_z: int, ratio: float | None, where: str = "true") -> str:
    near = f"abs(a.z - b.z) BETWEEN 1 AND {max_z} AND a.ord > b.ord" if max_z else "a.ord >= b.ord"
    candidates = f"""SELECT a.name, a.roi AS roi_a, b.roi AS roi_b, a.z AS z1, b.z AS z2, abs(a.z - b.z) AS z_dist, a.ord AS ord_1, b.ord AS ord_2, a.area AS area_a, b.area AS area_b, a.ori * b.ori AS oris, least(a.ymin, b.ymin) AS y0
    FROM {_celled(f"{s}ok")} a JOIN {_celled(f"{s}ok")} b ON a.name = b.name AND {near} AND {BOX}"""
    return f"""{s}ok AS (SELECT * FROM {s}p WHERE {where}),
{_compared(f"{s}x", candidates, f"{s}e", f"{s}e")},
{s}pairs AS MATERIALIZED (SELECT *, roi_a AS roi_1, roi_b AS roi_2, area_a AS area_1, area_b AS area_2 FROM {s}x WHERE {"true" if ratio is None else f"int_ratio >= {ratio}"})"""


def _reach(s: str) -> str:
    return f"""{s}links AS (SELECT name, ord_1 AS a, ord_2 AS b FROM {s}pairs UNION SELECT name, ord_2, ord_1 FROM {s}pairs),
{s}reach AS (SELECT name, a, b FROM {s}links UNION SELECT r.name, r.a, l.b FROM {s}reach r JOIN {s}links l ON l.name = r.name AND l.a = r.b),
{s}r AS (SELECT name, a AS node, min(b) AS component FROM {s}reach GROUP BY name, a)"""


def pairs(max_z: int, ratio: float | None, select: str, reach: bool = False) -> str:
    more = f",\n{_reach('')}" if reach else ""
    return f"WITH RECURSIVE {_polygons('', VERTICES)},\n{_pairs('', max_z, ratio)}{more}\n{select}"


def _features(s: str, vertices: str, max_z_dist: int = 1, min_z_span: int = 5, min_avg_area: float | None = None, include: bool = True, literal: bool = False) -> str:
    large = "true" if min_avg_area is None else f"mean_area >= {min_avg_area}"
    numbered = f"""{s}d AS (
    SELECT name, component, CASE WHEN valid THEN 'feature_' ELSE 'invalid_feature_' END || row_number() OVER (PARTITION BY name, valid ORDER BY first_edge) AS feature_id
    FROM (SELECT *, n_z_span >= {min_z_span} AND {large} AS valid FROM {s}c)
)"""
    if literal:
        numbered = f"""{s}k AS (SELECT *, dense_rank() OVER (PARTITION BY name ORDER BY label) AS place FROM {s}c),
{s}u AS (SELECT name, place AS label, row_number() OVER (PARTITION BY name ORDER BY place) AS number FROM {s}k WHERE n_z_span >= {min_z_span}),
{s}d AS (
    SELECT k.name, k.component, CASE WHEN u.number IS NOT NULL THEN 'feature_' || u.number ELSE 'invalid_feature_' || row_number() OVER (PARTITION BY k.name, u.number IS NULL ORDER BY first_edge) END AS feature_id
    FROM {s}k k LEFT JOIN {s}u u USING (name, label)
)"""
    return f"""{_polygons(s, vertices)},
{_pairs(s, max_z_dist, 0.0, "include" if include else "true")},
{_reach(s)},
{s}i AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ord_2, ord_1) AS edge_idx FROM {s}pairs),
{s}t AS (SELECT name, node, min(edge_idx) AS met FROM (SELECT name, ord_1 AS node, edge_idx FROM {s}i UNION ALL SELECT name, ord_2, edge_idx FROM {s}i) GROUP BY ALL),
{s}l AS (
    SELECT i.name, i.ord_1, i.edge_idx, sum((m.met = i.edge_idx AND o.met = i.edge_idx)::INT) OVER (PARTITION BY i.name ORDER BY i.edge_idx) AS label
    FROM {s}i i JOIN {s}t m ON m.name = i.name AND m.node = i.ord_1 JOIN {s}t o ON o.name = i.name AND o.node = i.ord_2
),
{s}c AS (
    SELECT * FROM (SELECT r.name, r.component, count(DISTINCT p.z) AS n_z_span, avg(p.area) AS mean_area FROM {s}r r JOIN {s}ok p ON p.name = r.name AND p.ord = r.node GROUP BY ALL)
    JOIN (SELECT l.name, r.component, min(edge_idx) AS first_edge, arg_min(label, edge_idx) AS label FROM {s}l l JOIN {s}r r ON r.name = l.name AND r.node = l.ord_1 GROUP BY ALL) USING (name, component)
),
{numbered},
{s}features AS MATERIALIZED (
    SELECT p.name, p.roi, p.z, p.ord, p.area, p.ori, p.xmin, p.ymin, p.xmax, p.ymax,
           coalesce(d.feature_id, CASE WHEN {"NOT p.include" if include else "false"} THEN 'failed_ROI_excluded' ELSE 'failed_ROI_overlap' END) AS feature_id
    FROM {s}p p LEFT JOIN {s}r r ON r.name = p.name AND r.node = p.ord LEFT JOIN {s}d d ON d.name = r.name AND d.component = r.component
)"""


def features(s: str, vertices: str, select: str, **parameters) -> str:
    return f"WITH RECURSIVE {_features('', vertices, **parameters)}\n{select}"


def matches(select: str) -> str:
    """CTEs m of all pairs of nucleolus and nucleus ROIs, a_features and b_features, and s of statistics by feature pair."""
    candidates = f"""SELECT a.name, a.roi AS roi_a, b.roi AS roi_b, a.feature_id AS f_id_1, b.feature_id AS f_id_2, a.area AS area_a, b.area AS area_b, a.ori * b.ori AS oris, least(a.ymin, b.ymin) AS y0
    FROM {_celled("a_features")} a JOIN {_celled("b_features")} b ON a.name = b.name AND a.z = b.z AND {BOX}"""
    return f"""WITH RECURSIVE {_features("a_", NUCLEOLI, max_z_dist=1, min_z_span=2, include=False)},
{_features("b_", VERTICES, max_z_dist=3, min_z_span=5, min_avg_area=100.0, include=False)},
{_compared("m", candidates, "a_e", "b_e")},
n1 AS (SELECT name, feature_id AS f_id_1, count(DISTINCT roi) AS n_roi_1 FROM a_features GROUP BY ALL),
n2 AS (SELECT name, feature_id AS f_id_2, count(DISTINCT roi) AS n_roi_2 FROM b_features GROUP BY ALL),
g AS (
    SELECT name, f_id_1, f_id_2, count(DISTINCT roi_a) AS n_roi_1_ovl, count(DISTINCT roi_b) AS n_roi_2_ovl
    FROM m WHERE int_ratio >= 0.5 AND f_id_1 LIKE 'feature%' AND f_id_2 LIKE 'feature%' GROUP BY ALL
),
s AS (SELECT *, least(n_roi_1_ovl, n_roi_2_ovl) / least(n_roi_1, n_roi_2) AS ratio FROM g JOIN n1 USING (name, f_id_1) JOIN n2 USING (name, f_id_2))
{select}"""


def pixels(select: str) -> str:
    return f"WITH px AS ({PIXELS})\n{select}"


def _regions(on: str) -> str:
    """CTE b of the pixels where ``on`` holds in channel 1, with their region."""
    return f"""px AS ({PIXELS}),
o AS (SELECT *, y::BIGINT * 1048576 + x AS id FROM px WHERE ch = 1 AND {on}),
reach AS (
    SELECT name, id AS a, id AS b FROM o
    UNION
    SELECT r.name, r.a, o.id FROM reach r JOIN o ON o.name = r.name AND o.id IN (r.b - 1, r.b + 1, r.b - 1048576, r.b + 1048576)
),
b AS (SELECT o.*, l.region FROM o JOIN (SELECT name, a, min(b) AS region FROM reach GROUP BY ALL) l ON l.name = o.name AND l.a = o.id)"""


def particles(select: str) -> str:
    return f"WITH RECURSIVE {_regions('v >= 100')}\n{select}"


def filled() -> str:
    return f"""WITH RECURSIVE {_regions("v < -100")},
w AS (SELECT name, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM px WHERE ch = 1 GROUP BY ALL),
h AS (SELECT b.name, b.region FROM b JOIN w USING (name) GROUP BY ALL HAVING NOT bool_or(x = x0 OR x = x1 OR y = y0 OR y = y1))
SELECT p.name, p.y, p.x, p.v >= -100 OR h.region IS NOT NULL AS "on"
FROM px p LEFT JOIN b ON b.name = p.name AND b.y = p.y AND b.x = p.x LEFT JOIN h ON h.name = b.name AND h.region = b.region WHERE p.ch = 1"""


def thresholds() -> str:
    return pixels("""SELECT name, ch, round(arg_min(middle, v), 6) AS threshold FROM (
    SELECT name, ch, v, lead(v) OVER w AS nxt, (sum(n * v) OVER w / sum(n) OVER w + (sum(n * v) OVER t - sum(n * v) OVER w) / nullif(sum(n) OVER t - sum(n) OVER w, 0)) / 2 AS middle
    FROM (SELECT name, ch, v, count(*) AS n FROM px GROUP BY ALL)
    WINDOW w AS (PARTITION BY name, ch ORDER BY v), t AS (PARTITION BY name, ch)
) WHERE middle < nxt GROUP BY name, ch""")


def fuzzy_thresholds(bins: int) -> str:
    return pixels(f"""SELECT name, ch, arg_min(top, (entropy, level)) AS threshold FROM (
    SELECT t.name, t.ch, t.level, t.top, round(sum(CASE WHEN g.d = 0 THEN 0 ELSE g.n * (-g.u * ln(g.u) - (1 - g.u) * ln(1 - g.u)) END) / any_value(t.n_all), 9) AS entropy
    FROM splits t JOIN (
        SELECT t.name, t.ch, t.level AS split, l.n, abs(l.level - CASE WHEN l.level <= t.level THEN t.below ELSE t.above END) AS d,
               1 / (1 + abs(l.level - CASE WHEN l.level <= t.level THEN t.below ELSE t.above END) / t.span) AS u
        FROM splits t JOIN levels l ON l.name = t.name AND l.ch = t.ch
    ) g ON g.name = t.name AND g.ch = t.ch AND g.split = t.level GROUP BY ALL
) GROUP BY name, ch""").replace(
        "\nSELECT name, ch, arg_min",
        f""",
ends AS (SELECT name, ch, min(v) AS lo, max(v) AS hi FROM px GROUP BY ALL),
levels AS (
    SELECT name, ch, least(floor((v - lo) / CASE WHEN hi - lo < {bins} THEN 1.0 ELSE (hi - lo) / {bins} END), {bins - 1})::INT AS level, count(*) AS n, max(v) AS top
    FROM px JOIN ends USING (name, ch) GROUP BY ALL
),
sums AS (
    SELECT *, sum(n) OVER w AS n_below, sum(n * level) OVER w AS s_below, sum(n) OVER t AS n_all, sum(n * level) OVER t AS s_all, (max(level) OVER t - min(level) OVER t)::DOUBLE AS span
    FROM levels WINDOW w AS (PARTITION BY name, ch ORDER BY level), t AS (PARTITION BY name, ch)
),
splits AS (SELECT *, floor(s_below / n_below + 0.5) AS below, floor((s_all - s_below) / (n_all - n_below) + 0.5) AS above FROM sums WHERE n_below < n_all)
SELECT name, ch, arg_min""",
        1,
    )


def distances(level: float) -> str:
    return pixels(f"""SELECT a.name, a.y, a.x, a.v >= {level} AS "on", CASE WHEN a.v < {level} THEN 0.0 ELSE round(sqrt(min(CASE WHEN b.v < {level} THEN (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) END)), 6) END AS distance
FROM px a JOIN px b ON b.name = a.name AND b.ch = a.ch WHERE a.ch = 1 AND b.v < {level} GROUP BY a.name, a.y, a.x, a.v""")


def trimmed(level: float, pixels_off: int) -> str:
    return pixels(f"""SELECT a.name, a.y, a.x FROM px a JOIN px b ON b.name = a.name AND b.ch = a.ch AND abs(a.x - b.x) <= {pixels_off} AND abs(a.y - b.y) <= {pixels_off}
WHERE a.ch = 1 GROUP BY ALL HAVING min(b.v) >= {level}""")


def ringed() -> str:
    """Holes of a region by its pixels, pairs of neighbours and full squares of four; sides by pixels and pairs."""
    return f"""WITH RECURSIVE {_regions('v >= 0')},
beside AS (SELECT u.name, u.region, count(*) AS n FROM b u JOIN b w ON w.name = u.name AND w.region = u.region AND ((w.x = u.x + 1 AND w.y = u.y) OR (w.x = u.x AND w.y = u.y + 1)) GROUP BY ALL),
squares AS (
    SELECT u.name, u.region, count(*) AS n FROM b u JOIN b r ON r.name = u.name AND r.region = u.region AND r.x = u.x + 1 AND r.y = u.y
    JOIN b d ON d.name = u.name AND d.region = u.region AND d.x = u.x AND d.y = u.y + 1 JOIN b q ON q.name = u.name AND q.region = u.region AND q.x = u.x + 1 AND q.y = u.y + 1 GROUP BY ALL
)
SELECT b.name, b.region, count(*)::DOUBLE AS area, 1 - count(*) + coalesce(any_value(p.n), 0) - coalesce(any_value(s.n), 0) AS n_holes, 4 * count(*) - 2 * coalesce(any_value(p.n), 0) AS sides
FROM b LEFT JOIN beside p ON p.name = b.name AND p.region = b.region LEFT JOIN squares s ON s.name = b.name AND s.region = b.region GROUP BY b.name, b.region"""


def ring_overlaps() -> str:
    """Regions of high and of low values with pixels that touch, and the pixels they share: as wholes, each is in the other or apart."""
    return f"""WITH RECURSIVE {_regions('v >= 100')},
o2 AS (SELECT name, y, x, y::BIGINT * 1048576 + x AS id FROM px WHERE ch = 2 AND v >= 0),
reach2 AS (
    SELECT name, id AS a, id AS b FROM o2
    UNION
    SELECT r.name, r.a, o2.id FROM reach2 r JOIN o2 ON o2.name = r.name AND o2.id IN (r.b - 1, r.b + 1, r.b - 1048576, r.b + 1048576)
),
b2 AS (SELECT o2.*, l.region FROM o2 JOIN (SELECT name, a, min(b) AS region FROM reach2 GROUP BY ALL) l ON l.name = o2.name AND l.a = o2.id)
SELECT b.name, b.region AS region_1, b2.region AS region_2, count(*) FILTER (b.x = b2.x AND b.y = b2.y)::DOUBLE AS int_area
FROM b JOIN b2 ON b2.name = b.name AND abs(b.x - b2.x) <= 1 AND abs(b.y - b2.y) <= 1 GROUP BY ALL"""


def _about_first(s: str = "") -> str:
    """CTEs of polygons and of edges about each ROI's first vertex, with the cross product."""
    return f"""{_polygons(s, VERTICES)},
{s}o AS (SELECT name, roi, x1 AS ox, y1 AS oy FROM {s}e WHERE i = 0),
{s}m AS (SELECT name, roi, i, x1 - ox AS x1, y1 - oy AS y1, x2 - ox AS x2, y2 - oy AS y2, (x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy) AS c FROM {s}e JOIN {s}o USING (name, roi))"""


def moment_ellipses(select: str) -> str:
    """CTE t of ROIs with centre, major, minor and angle of the ellipse of the same moments and area."""
    return f"""WITH {_about_first()},
sums AS (
    SELECT name, roi, sum(c) / 2 AS a, sum((x1 + x2) * c) AS sx, sum((y1 + y2) * c) AS sy, sum((x1 * x1 + x1 * x2 + x2 * x2) * c) AS sxx, sum((y1 * y1 + y1 * y2 + y2 * y2) * c) AS syy,
           sum((x1 * y2 + 2 * x1 * y1 + 2 * x2 * y2 + x2 * y1) * c) AS sxy FROM m GROUP BY ALL
),
central AS (
    SELECT name, roi, abs(a) AS a, sx / (6 * a) AS mx, sy / (6 * a) AS my, sxx / (12 * a) - (sx / (6 * a)) ** 2 AS xx, syy / (12 * a) - (sy / (6 * a)) ** 2 AS yy, sxy / (24 * a) - sx / (6 * a) * sy / (6 * a) AS xy
    FROM sums WHERE a <> 0
),
axes AS (SELECT *, (xx + yy) / 2 AS h, sqrt((xx - yy) * (xx - yy) / 4 + xy * xy) AS r FROM central),
t AS (
    SELECT name, roi, ox + mx AS x, oy + my AS y, 2 * sqrt(h + r) * sqrt(a / (pi() * sqrt(h + r) * sqrt(h - r))) AS major, 2 * sqrt(h - r) * sqrt(a / (pi() * sqrt(h + r) * sqrt(h - r))) AS minor,
           CASE WHEN r > 1e-12 * h THEN atan2(2 * xy, xx - yy) / 2 ELSE 0 END AS turn
    FROM axes JOIN o USING (name, roi)
)
{select}"""


def calipers(select: str) -> str:
    """CTE f of ROIs with largest and smallest width and the area of the hull, whose sides are pairs of vertices with all others to the left."""
    return f"""WITH {_polygons('', VERTICES)},
corners AS (SELECT DISTINCT name, roi, x, y FROM v),
pairs AS (SELECT a.name, a.roi, a.x AS px, a.y AS py, b.x AS qx, b.y AS qy FROM corners a JOIN corners b ON a.name = b.name AND a.roi = b.roi AND (a.x <> b.x OR a.y <> b.y)),
widest AS (SELECT name, roi, sqrt(max((qx - px) * (qx - px) + (qy - py) * (qy - py))) AS feret FROM pairs GROUP BY ALL),
sides AS (
    SELECT p.name, p.roi, px, py, qx, qy, max((qx - px) * (c.y - py) - (qy - py) * (c.x - px)) / sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py)) AS across
    FROM pairs p JOIN corners c ON c.name = p.name AND c.roi = p.roi GROUP BY p.name, p.roi, px, py, qx, qy
    HAVING bool_and((qx - px) * (c.y - py) - (qy - py) * (c.x - px) > 0 OR ((qx - px) * (c.y - py) - (qy - py) * (c.x - px) = 0 AND (c.x - px) * (c.x - qx) + (c.y - py) * (c.y - qy) <= 0))
),
f AS (SELECT name, roi, any_value(feret) AS feret, min(across) AS min_feret, sum(px * qy - qx * py) / 2 AS hull_area FROM sides JOIN widest USING (name, roi) GROUP BY name, roi)
{select}"""
