"""The registered queries over the given tables, and the SQL that another engine answers them with."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import labels as L
from ..operators import raster as R
from ..operators import selector as S
from ..operators.components import connected_components
from ..operators.features import as_polygons, component_table, define_feature_group, fail_reasons, filter_features, slice_by_rank
from ..operators.match import find_overlap_features, first_match, match_statistics
from ..operators.numbering import numbered, running_total
from ..operators.overlap import find_z_intersect, measured, roi_polygons, same_slice_pairs
from ..operators.shapes import add_ellipses, shape_table
from ..sources import fixtures as X
from ..sources import stacks
from ..sources.tables import append_outlines, in_file_order, path_list, read_measurements, read_outlines, read_polygons, write_measurements, write_outlines, write_polygons
from ..streaming.outlines import group_arriving, stream_outlines
from . import oracle as O
from .scratch import materialize, scratch_path

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

#: The parameters of the reference scenarios.
NUCLEUS = {"max_z_dist": 3, "min_z_span": 5, "min_avg_area": 100.0}
NUCLEOLUS = {"max_z_dist": 1, "min_z_span": 2}
REGEX = "[02468]$"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _polygons(spark: SparkSession, sf: str) -> DataFrame:
    return as_polygons(X.vertices(spark, sf))


def _stored_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons as a table, for queries that look at them more than once."""
    return materialize(_polygons(spark, sf), "polygons")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- polygons and filters ---------------------------------------------------------


@query(O.polygons("SELECT name, roi, z, round(area, 6) AS area FROM p"))
def polygon_area(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_polygons(spark, sf).select("name", "roi", "z", "area"), "area")


@query(O.polygons("SELECT name, roi, z, n AS n_points, xmin, ymin, xmax, ymax FROM p"))
def roi_polygonize(spark: SparkSession, sf: str) -> DataFrame:
    return _polygons(spark, sf).select("name", "roi", "z", F.size("ring").cast("long").alias("n_points"), "xmin", "ymin", "xmax", "ymax")


@query(O.polygons("SELECT name, roi, round(12.566370614359172 * area / (per * per), 6) AS circ, round(per, 6) AS perimeter FROM p"))
def roi_shape(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_polygons(spark, sf).select("name", "roi", G.circularity(F.col("ring")).alias("circ"), G.perimeter(F.col("ring")).alias("perimeter")), "circ", "perimeter")


@query(O.with_vertices("SELECT name, roi, round(ex, 6) AS x, round(ey, 6) AS y, round(4 * sqrt(h + r), 6) AS major, round(4 * sqrt(greatest(h - r, 0)), 6) AS minor FROM (SELECT name, roi, avg(x) AS ex, avg(y) AS ey, (var_pop(x) + var_pop(y)) / 2 AS h, sqrt((var_pop(x) - var_pop(y)) * (var_pop(x) - var_pop(y)) / 4 + covar_pop(x, y) * covar_pop(x, y)) AS r FROM v GROUP BY name, roi)"))
def roi_ellipse(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_polygons(spark, sf).select("name", "roi", G.ellipse(F.col("ring")).alias("e")).select("name", "roi", "e.x", "e.y", "e.major", "e.minor"), "x", "y", "major", "minor")


@query(O.moment_ellipses("SELECT name, roi, round(x, 6) AS x, round(y, 6) AS y, round(major, 6) AS major, round(minor, 6) AS minor, round(CASE WHEN turn < 0 THEN degrees(turn) + 180 ELSE degrees(turn) END, 6) AS angle, round(minor / major, 6) AS roundness FROM t"))
def roi_moment_ellipse(spark: SparkSession, sf: str) -> DataFrame:
    fitted = _polygons(spark, sf).withColumn("e", G.moment_ellipse(F.col("ring"))).select("name", "roi", "e.*")
    return _rounded(fitted.withColumn("roundness", F.col("minor") / F.col("major")), "x", "y", "major", "minor", "angle", "roundness")


ELLIPSE_POINTS = "SELECT name, concat(roi, '_ellipse') AS roi, x + major / 2 * cos(k * pi() / 16) * cos(turn) - minor / 2 * sin(k * pi() / 16) * sin(turn) AS px, y + major / 2 * cos(k * pi() / 16) * sin(turn) + minor / 2 * sin(k * pi() / 16) * cos(turn) AS py, k FROM t, range(32) r(k)"


@query(O.moment_ellipses(f"SELECT name, roi, n_points, round(xmin, 5) AS xmin, round(ymax, 5) AS ymax, round(area, 5) AS area FROM (SELECT name, roi, count(*) AS n_points, min(px) AS xmin, max(py) AS ymax, abs(sum(px * ny - nx * py)) / 2 AS area FROM (SELECT *, coalesce(lead(px) OVER w, first(px) OVER w) AS nx, coalesce(lead(py) OVER w, first(py) OVER w) AS ny FROM ({ELLIPSE_POINTS}) WINDOW w AS (PARTITION BY name, roi ORDER BY k)) GROUP BY ALL UNION ALL SELECT name, roi, n, xmin, ymax, area FROM p)"))
def rois_with_ellipses(spark: SparkSession, sf: str) -> DataFrame:
    both = as_polygons(add_ellipses(_polygons(spark, sf), 32))
    return both.select("name", "roi", F.size("ring").cast("long").alias("n_points"), F.round("xmin", 5).alias("xmin"), F.round("ymax", 5).alias("ymax"), F.round("area", 5).alias("area"))


@query(O.calipers("SELECT name, roi, round(feret, 6) AS feret, round(min_feret, 6) AS min_feret, round(hull_area, 6) AS hull_area, round(area / hull_area, 6) AS solidity FROM f JOIN p USING (name, roi)"))
def roi_feret(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(shape_table(_polygons(spark, sf)).select("name", "roi", "feret", "min_feret", "hull_area", "solidity"), "feret", "min_feret", "hull_area", "solidity")


@query(O.with_vertices("SELECT name, roi, round(x * 0.25, 6) AS x_um, round(y * 0.25, 6) AS y_um FROM v"))
def physical_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(X.vertices(spark, sf).select("name", "roi", G.physical(F.col("x"), 0.25).alias("x_um"), G.physical(F.col("y"), 0.25).alias("y_um")), "x_um", "y_um")


@query(O.polygons("SELECT name, roi, z FROM p WHERE include"))
def filter_flag_any(spark: SparkSession, sf: str) -> DataFrame:
    return fail_reasons(_polygons(spark, sf), area_range=None).where("fail_reason IS NULL").select("name", "roi", "z")


@query(O.polygons("SELECT name, roi, n AS n_points, round(area, 6) AS area FROM p WHERE include AND xmin >= 100"))
def polygons_of_rois(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons of a list of ROIs, of which some have no vertices and are warned of."""
    vertices = X.vertices(spark, sf)
    wanted = vertices.groupBy("name", "roi").agg(F.bool_or("include").alias("include"), F.min("x").alias("x")).where("include AND x >= 100").select("name", "roi")
    wanted = wanted.unionByName(wanted.where("roi LIKE '%0'").withColumn("roi", F.concat("roi", F.lit("_gone"))))
    found = measured(roi_polygons(vertices, wanted, 3))
    return _rounded(found.select("name", "roi", F.size("ring").cast("long").alias("n_points"), "area"), "area")


@query(O.polygons(f"SELECT name, roi, z FROM p WHERE regexp_matches(roi, '{REGEX}')"))
def filter_name_regex(spark: SparkSession, sf: str) -> DataFrame:
    return fail_reasons(_polygons(spark, sf), None, None, REGEX).where("fail_reason IS NULL").select("name", "roi", "z")


@query(O.polygons("SELECT name, roi, z FROM p WHERE area BETWEEN 60 AND 200"))
def filter_area_range(spark: SparkSession, sf: str) -> DataFrame:
    return fail_reasons(_polygons(spark, sf), None, (200, 60)).where("fail_reason IS NULL").select("name", "roi", "z")


@query(O.polygons(f"SELECT name, roi, CASE WHEN NOT include THEN 'excluded' WHEN NOT regexp_matches(roi, '{REGEX}') THEN 'name' WHEN area NOT BETWEEN 60 AND 200 THEN 'area' ELSE 'passed' END AS reason FROM p"))
def filter_cascade_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return fail_reasons(_polygons(spark, sf), "include", (60, 200), REGEX).select("name", "roi", F.coalesce("fail_reason", F.lit("passed")).alias("reason"))


# --- overlap over slices -----------------------------------------------------------

PAIR = "name, roi_1, roi_2, z1, z2, z_dist"


def _pairs(df: DataFrame) -> DataFrame:
    return _rounded(df.select("name", "roi_1", "roi_2", "z1", "z2", "z_dist", "int_area", "int_ratio"), "int_area", "int_ratio")


@query(O.pairs(1, 0.0, f"SELECT {PAIR}, round(int_area, 6) AS int_area, round(int_ratio, 6) AS int_ratio FROM pairs"))
def overlap_pairs_z1(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(find_z_intersect(_stored_polygons(spark, sf)))


@query(O.pairs(3, 0.0, f"SELECT {PAIR}, round(int_area, 6) AS int_area, round(int_ratio, 6) AS int_ratio FROM pairs"))
def overlap_pairs_z3(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(find_z_intersect(_stored_polygons(spark, sf), max_z_dist=3))


@query(O.pairs(1, 0.3, "SELECT name, roi_1, roi_2, round(area_1, 6) AS area_1, round(area_2, 6) AS area_2, round(min_area, 6) AS min_area, round(int_ratio, 6) AS int_ratio FROM pairs"))
def overlap_ratio(spark: SparkSession, sf: str) -> DataFrame:
    found = find_z_intersect(_stored_polygons(spark, sf), min_intersect_ratio=0.3)
    return _rounded(found.select("name", "roi_1", "roi_2", "area_1", "area_2", "min_area", "int_ratio"), "area_1", "area_2", "min_area", "int_ratio")


@query(O.pairs(1, 0.0, f"SELECT {PAIR} FROM pairs WHERE round(int_area, 9) = 0"))
def overlap_touch_only(spark: SparkSession, sf: str) -> DataFrame:
    return find_z_intersect(_stored_polygons(spark, sf)).where(F.round("int_area", 9) == 0).select("name", "roi_1", "roi_2", "z1", "z2", "z_dist")


@query(O.pairs(2, 0.0, f"SELECT {PAIR} FROM pairs"))
def overlap_pairs_grid(spark: SparkSession, sf: str) -> DataFrame:
    return find_z_intersect(_stored_polygons(spark, sf), max_z_dist=2, cell=32.0).select("name", "roi_1", "roi_2", "z1", "z2", "z_dist")


@query(O.pairs(0, None, "SELECT name, roi_1, roi_2 FROM pairs"))
def overlap_pairs_any_z(spark: SparkSession, sf: str) -> DataFrame:
    return find_z_intersect(_stored_polygons(spark, sf), max_z_dist=0, min_intersect_ratio=None, cell=64.0).select("name", "roi_1", "roi_2")


# --- features ------------------------------------------------------------------------


def _features(spark: SparkSession, sf: str, **parameters) -> DataFrame:
    return define_feature_group(X.vertices(spark, sf), **parameters)


FEATURE = "SELECT name, roi, z, round(area, 6) AS area, feature_id FROM features"


def _listed(df: DataFrame) -> DataFrame:
    return _rounded(df.select("name", "roi", "z", "area", "feature_id"), "area")


@query(O.pairs(1, 0.0, "SELECT r.name, p.roi, q.roi AS first_roi FROM r JOIN p ON p.name = r.name AND p.ord = r.node JOIN p q ON q.name = r.name AND q.ord = r.component", reach=True))
def feature_components(spark: SparkSession, sf: str) -> DataFrame:
    polygons = _stored_polygons(spark, sf)
    pairs = find_z_intersect(polygons)
    found = connected_components(pairs.select("name", F.col("ord_1").alias("a"), F.col("ord_2").alias("b")))
    rois = polygons.select("name", "ord", "roi")
    named = found.join(rois.withColumnRenamed("ord", "node"), ["node", "name"])
    return named.join(rois.select("name", F.col("ord").alias("component"), F.col("roi").alias("first_roi")), ["component", "name"]).select("name", "roi", "first_roi")


def _component_stats(spark: SparkSession, sf: str) -> DataFrame:
    polygons = _stored_polygons(spark, sf)
    return component_table(polygons, materialize(find_z_intersect(polygons).select("name", "ord_1", "ord_2"), "pairs"))[1]


@query(O.features("v", X.VERTICES, "SELECT name, component, n_z_span FROM c", include=False))
def feature_zspan(spark: SparkSession, sf: str) -> DataFrame:
    return _component_stats(spark, sf).select("name", "component", "n_z_span")


@query(O.features("v", X.VERTICES, "SELECT name, component, round(mean_area, 6) AS mean_area FROM c WHERE mean_area >= 100", include=False))
def feature_mean_area(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_component_stats(spark, sf).where("mean_area >= 100").select("name", "component", "mean_area"), "mean_area")


@query(O.features("v", X.VERTICES, FEATURE))
def define_feature_group_query(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(_features(spark, sf))


for _d in (QUERIES, ORACLE_SQL):
    _d["define_feature_group"] = _d.pop("define_feature_group_query")


@query(O.features("v", X.VERTICES, FEATURE, **NUCLEUS))
def define_feature_group_minarea(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(_features(spark, sf, **NUCLEUS))


@query(O.features("v", X.VERTICES, FEATURE, literal=True))
def define_feature_group_literal(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(_features(spark, sf, compat="literal"))


@query(O.features("v", X.VERTICES, "SELECT name, feature_id, count(*) AS n FROM features GROUP BY ALL"))
def feature_id_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).groupBy("name", "feature_id").agg(F.count("*").alias("n"))


@query(O.features("v", X.VERTICES, "SELECT name, roi FROM features WHERE feature_id = 'failed_ROI_overlap'"))
def unmatched_rois(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).where("feature_id = 'failed_ROI_overlap'").select("name", "roi")


@query(O.features("v", X.VERTICES, "SELECT name, roi, feature_id FROM features WHERE regexp_matches(lower(feature_id), '^failed_roi')"))
def filter_folded(spark: SparkSession, sf: str) -> DataFrame:
    return filter_features(_features(spark, sf), "^failed_roi", fold_case=True).select("name", "roi", "feature_id")


@query(O.polygons("SELECT name, roi, z FROM p WHERE z = (SELECT z FROM (SELECT DISTINCT z FROM p) ORDER BY z LIMIT 1 OFFSET 4)"))
def slice_of_rank(spark: SparkSession, sf: str) -> DataFrame:
    return slice_by_rank(_polygons(spark, sf).select("name", "roi", "z"), 5)


# --- matching --------------------------------------------------------------------------


def _both(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return define_feature_group(X.nucleoli(spark, sf), feature_prefix="feature_", **NUCLEOLUS), _features(spark, sf, pre_roi_filter_colname=None, **NUCLEUS)


@query(O.matches("SELECT name, roi_a AS roi_1, roi_b AS roi_2, round(int_ratio, 6) AS int_ratio FROM m"))
def match_roi_pairs(spark: SparkSession, sf: str) -> DataFrame:
    found = same_slice_pairs(materialize(as_polygons(X.nucleoli(spark, sf)), "polygons"), _stored_polygons(spark, sf), [])
    return _rounded(found.select(F.col("name_a").alias("name"), F.col("roi_a").alias("roi_1"), F.col("roi_b").alias("roi_2"), "int_ratio"), "int_ratio")


@query(O.matches("SELECT name, f_id_1, f_id_2, n_roi_1, n_roi_2, least(n_roi_1, n_roi_2) AS min_roi, n_roi_1_ovl, n_roi_2_ovl, round(ratio, 6) AS ratio_roi_ovl FROM s"))
def match_feature_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(match_statistics(*_both(spark, sf), "^feature_", "^feature_", 0.5), "ratio_roi_ovl")


@query(O.matches("SELECT name, f_id_1 AS feature_id_1, f_id_2 AS feature_id_2 FROM s WHERE ratio >= 0.75"))
def match_features(spark: SparkSession, sf: str) -> DataFrame:
    return find_overlap_features(*_both(spark, sf), "^feature_", "^feature_", 0.5, 0.75)


@query(O.matches("SELECT a.name, a.roi, k.f_id_2 AS nucleus_id FROM a_features a LEFT JOIN (SELECT name, f_id_1, min(f_id_2) AS f_id_2 FROM s WHERE ratio >= 0.75 GROUP BY ALL) k ON k.name = a.name AND k.f_id_1 = a.feature_id"))
def nucleus_map(spark: SparkSession, sf: str) -> DataFrame:
    nucleoli, nuclei = _both(spark, sf)
    # both the match and the map look at the nucleoli: they are grouped once
    nucleoli = materialize(nucleoli, "nucleoli")
    lookup = first_match(find_overlap_features(nucleoli, nuclei, "^feature_", "^feature_", 0.5, 0.75), ["name", "feature_id_1"], "feature_id_2", ["feature_id_2"])
    lookup = lookup.withColumnsRenamed({"feature_id_1": "feature_id", "feature_id_2": "nucleus_id"})
    return nucleoli.select("name", "roi", "feature_id").join(lookup, ["name", "feature_id"], "left").select("name", "roi", "nucleus_id")


# --- tables --------------------------------------------------------------------------------


@query(O.with_vertices("SELECT name, roi, z, row_number() OVER (ORDER BY z % 2 = 0, ord) - 1 AS idx, x, y FROM v"))
def outlines_appended(spark: SparkSession, sf: str) -> DataFrame:
    """Outlines of odd slices, then of even ones, appended to one table; the second append is tried twice and made once."""
    path, rows = scratch_path(spark, "outlines"), X.vertices(spark, sf).drop("include")
    for slices, tries in ((1, 1), (0, 2)):
        for _ in range(tries):
            append_outlines(spark, rows.where(F.col("z") % 2 == slices), path, f"slices {slices}")
    return read_outlines(spark, path).select("name", "roi", "z", "idx", "x", "y")


@query(O.with_vertices("SELECT name, roi, z, x, y FROM v"))
def outlines_white_space(spark: SparkSession, sf: str) -> DataFrame:
    """Outlines written as text and read back with any white space as the separator."""
    path = scratch_path(spark, "outline-text")
    write_outlines(X.vertices(spark, sf).select("name", "roi", "z", "x", "y"), path)
    return read_outlines(spark, path, white_space=True).select("name", "roi", "z", "x", "y")


@query(O.matches("SELECT name, roi, z, i, x, y FROM a_e"))
def outline_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two kinds of outlines written as compressed text, one found again by its path; vertices are numbered in the order of the files."""
    paths = path_list(scratch_path(spark, "outline-files"), {"nuclei": "sample_nucleus_outline.txt", "nucleoli": "sample_nucleolus_outline.txt"})
    for kind, rows in (("nuclei", X.vertices(spark, sf)), ("nucleoli", X.nucleoli(spark, sf))):
        write_outlines(rows.repartitionByRange("name", "ord").sortWithinPartitions("name", "ord").select("name", "roi", "z", "x", "y"), paths[kind], compression="gzip")
    found = in_file_order(read_outlines(spark, list(paths.values()), pattern="*.csv.gz", regex=r"nucleolus_outline\.txt/"))
    order = Window.partitionBy("name", "roi").orderBy("ord")
    return found.select("name", "roi", "z", (F.row_number().over(order) - 1).cast("long").alias("i"), "x", "y")


@query(O.measurements("SELECT label, area, circ, t[1] AS filename, t[2] AS pos, t[3] AS roi, CAST(regexp_extract(label, 'z:(\\d+)', 1) AS INT) AS z FROM (SELECT *, string_split_regex(label, '(/)|(\\s+)|(:)') AS t FROM m)"))
def measurement_file(spark: SparkSession, sf: str) -> DataFrame:
    """A measurement table written with row numbers and an image tool's column names, and read back."""
    path, own = scratch_path(spark, "measurements"), numbered(X.measurements(spark, sf), [], ["roi_name", "ch"])
    rows = own.select("n", F.col("label").alias("Label"), F.col("area").alias("Area"), F.col("circ").alias("Circ."))
    write_measurements(rows.repartitionByRange("n").sortWithinPartitions("n"), path)
    return read_measurements(spark, path).select("label", "area", "circ", "filename", "pos", "roi", "z")


@query(O.features("v", X.VERTICES, FEATURE, include=False))
def streamed_features(spark: SparkSession, sf: str) -> DataFrame:
    """Outline files that arrive in a folder, half of them at a time, a position in any number of them, grouped by a stream."""
    path = scratch_path(spark, "arriving")
    # ranges of a position's rows, so that no task sorts or writes a whole position
    rows = X.vertices(spark, sf).repartitionByRange("name", "ord").sortWithinPartitions("name", "ord")
    write_outlines(rows.select("name", "roi", "z", "x", "y"), f"{path}/in")
    files = len(spark.read.text(f"{path}/in").inputFiles())
    arriving = stream_outlines(spark, f"{path}/in", max_files=max(1, (files + 1) // 2))

    def replace(features: DataFrame, number: int) -> None:
        _listed(features).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("name").parquet(f"{path}/out")

    group_arriving(arriving, replace, f"{path}/state", keep=True).awaitTermination()
    return spark.read.schema("roi string, z int, area double, feature_id string, name string").parquet(f"{path}/out").select("name", "roi", "z", "area", "feature_id")


@query(O.polygons("SELECT name, roi, z, round(area, 6) AS area FROM p WHERE xmax >= 200 AND xmin <= 320 AND ymax >= 30 AND ymin <= 90"))
def polygons_in_box(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons stored along a curve, then those of an area."""
    path = scratch_path(spark, "polygons")
    write_polygons(_polygons(spark, sf), path)
    return _rounded(read_polygons(spark, path, (200, 30, 320, 90)).select("name", "roi", "z", "area"), "area")


# --- labels and measurements ----------------------------------------------------------------


@query(O.measurements("SELECT DISTINCT label, len(t) AS n_tokens, t[1] AS first_token, t[len(t)] AS last_token FROM (SELECT label, string_split_regex(label, '(/)|(\\s+)|(:)') AS t FROM m)"))
def label_tokens(spark: SparkSession, sf: str) -> DataFrame:
    t = L.tokens(F.col("label"))
    return X.measurements(spark, sf).select("label", F.size(t).cast("long").alias("n_tokens"), F.get(t, F.lit(0)).alias("first_token"), F.element_at(t, -1).alias("last_token")).distinct()


@query(O.measurements("SELECT label, CAST(regexp_extract(label, 'z:(\\d+)', 1) AS INT) AS z, CAST(regexp_extract(label, 'c:(\\d+)', 1) AS INT) AS c FROM m"))
def label_z_extract(spark: SparkSession, sf: str) -> DataFrame:
    return X.measurements(spark, sf).select("label", L.slice_number(F.col("label")).alias("z"), L.channel_number(F.col("label")).alias("c"))


@query(O.measurements("SELECT label, t[1] AS filename, t[2] AS pos, t[3] AS roi, CAST(regexp_extract(label, 'z:(\\d+)', 1) AS INT) AS z FROM (SELECT label, string_split_regex(label, '(/)|(\\s+)|(:)') AS t FROM m)"))
def label_content_names(spark: SparkSession, sf: str) -> DataFrame:
    return L.parse_labels(X.measurements(spark, sf).select("label")).select("label", "filename", "pos", "roi", "z")


@query(O.measurements("SELECT v.name, v.roi, bool_or(v.roi IN (SELECT roi_name FROM m WHERE circ > 0.7)) AS include FROM v GROUP BY v.name, v.roi", vertices=True))
def include_by_circ(spark: SparkSession, sf: str) -> DataFrame:
    good = X.measurements(spark, sf).where("circ > 0.7").select(F.col("roi_name").alias("roi")).distinct().withColumn("include", F.lit(True))
    rois = X.vertices(spark, sf).select("name", "roi").distinct()
    return rois.join(good, "roi", "left").select("name", "roi", F.coalesce("include", F.lit(False)).alias("include"))


@query(O.with_vertices("SELECT DISTINCT name, roi, regexp_extract(roi, '^[a-zA-Z]+') AS roi_type FROM v"))
def roi_type_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return X.vertices(spark, sf).select("name", "roi", L.roi_type(F.col("roi")).alias("roi_type")).distinct()


@query(O.polygons("SELECT name, CASE WHEN n BETWEEN 10 AND 99 THEN concat('cell_', roi, '_b') ELSE roi END AS roi FROM (SELECT name, roi, row_number() OVER (PARTITION BY name ORDER BY ord) - 1 AS n FROM p)"))
def rename_prefix_range(spark: SparkSession, sf: str) -> DataFrame:
    rois = numbered(_polygons(spark, sf).select("name", "roi", "ord"), ["name"], ["ord"])
    return rois.select("name", L.renamed(F.col("n") - 1, F.col("roi"), 10, 100, "cell_", "_b").alias("roi"))


@query(O.polygons("SELECT name, roi, sum(n) OVER (PARTITION BY name ORDER BY ord)::BIGINT - n AS idx, sum(n) OVER (ORDER BY name, ord)::BIGINT AS points FROM p"))
def vertex_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Where each ROI's vertices begin in its position's table, and how many there are up to its end over all positions."""
    rois = _polygons(spark, sf).select("name", "roi", "ord", F.size("ring").cast("long").alias("points"))
    placed = running_total(running_total(rois, ["name"], ["ord"], F.col("points"), "idx"), [], ["name", "ord"], F.col("points"), "total")
    return placed.select("name", "roi", (F.col("idx") - F.col("points")).alias("idx"), F.col("total").alias("points"))


@query(O.measurements("SELECT split_part(label, '/', 2) AS position, count(*) AS n FROM (SELECT string_split(label, '/')[2] AS part, label FROM m) GROUP BY ALL"))
def position_from_label(spark: SparkSession, sf: str) -> DataFrame:
    return X.measurements(spark, sf).groupBy(L.position_part(F.col("label")).alias("position")).agg(F.count("*").alias("n"))


PALETTE = "[" + ", ".join(f"'{c}'" for c in L.PAIRED) + "]"
SET3 = "[" + ", ".join(f"'{c}'" for c in L.PALETTES["Set3"]) + "]"
RANKED = "SELECT name, feature_id, dense_rank() OVER (PARTITION BY name ORDER BY feature_id) AS k FROM (SELECT DISTINCT name, feature_id FROM features"


@query(O.features("v", X.VERTICES, f"SELECT name, feature_id, {PALETTE}[(k - 1) % 12 + 1] AS colour FROM ({RANKED} WHERE feature_id LIKE 'feature%'))"))
def feature_palette(spark: SparkSession, sf: str) -> DataFrame:
    ids = _features(spark, sf).where(F.col("feature_id").startswith("feature")).select("name", "feature_id").distinct()
    return numbered(ids, ["name"], ["feature_id"]).select("name", "feature_id", L.palette_colour(F.col("n")).alias("colour"))


@query(O.features("v", X.VERTICES, f"SELECT name, feature_id, {SET3}[(k - 1) % 12 + 1] AS colour FROM ({RANKED} WHERE feature_id LIKE 'invalid%'))"))
def invalid_feature_palette(spark: SparkSession, sf: str) -> DataFrame:
    ids = _features(spark, sf).where(F.col("feature_id").startswith("invalid")).select("name", "feature_id").distinct()
    return numbered(ids, ["name"], ["feature_id"]).select("name", "feature_id", L.palette_colour(F.col("n"), "Set3").alias("colour"))


@query(O.features("v", X.VERTICES, f"SELECT name, feature_id, CASE WHEN feature_id LIKE 'failed%' THEN 'gray80' WHEN feature_id LIKE 'invalid%' THEN 'gray40' ELSE {PALETTE}[(k - 1) % 12 + 1] END AS colour FROM ({RANKED}))"))
def feature_color_map(spark: SparkSession, sf: str) -> DataFrame:
    ids = _features(spark, sf).select("name", "feature_id").distinct()
    return numbered(ids, ["name"], ["feature_id"]).select("name", "feature_id", L.feature_colour(F.col("feature_id"), F.col("n")).alias("colour"))


@query(O.with_vertices("SELECT name, round(min(x) * 0.9, 6) AS x_lo, round(max(x) * 1.1, 6) AS x_hi, round(min(y) * 0.9, 6) AS y_lo, round(max(y) * 1.1, 6) AS y_hi FROM v GROUP BY name"))
def plot_extent(spark: SparkSession, sf: str) -> DataFrame:
    ends = X.vertices(spark, sf).groupBy("name").agg(*[(f(a) * w).alias(f"{a}_{s}") for a in "xy" for f, w, s in ((F.min, 0.9, "lo"), (F.max, 1.1, "hi"))])
    return _rounded(ends, "x_lo", "x_hi", "y_lo", "y_hi")


@query(O.polygons("SELECT roi, count(*) AS n FROM (SELECT roi FROM p UNION ALL SELECT roi FROM p WHERE z = 1) GROUP BY roi HAVING count(*) > 1"))
def duplicate_roi_check(spark: SparkSession, sf: str) -> DataFrame:
    polygons = _polygons(spark, sf).select("roi", "z")
    return polygons.unionByName(polygons.where("z = 1")).groupBy("roi").agg(F.count("*").alias("n")).where("n > 1")


@query(O.polygons("SELECT name, CAST(least(floor((area - lo) / (hi - lo) * 20) + 1, 20) AS BIGINT) AS bin, count(*) AS n FROM p, (SELECT min(area) AS lo, max(area) AS hi FROM p) GROUP BY ALL"))
def area_histogram(spark: SparkSession, sf: str) -> DataFrame:
    polygons = _polygons(spark, sf).select("name", "area")
    lo, hi = polygons.agg(F.min("area"), F.max("area")).first()
    place = F.least(F.floor((F.col("area") - lo) / (hi - lo) * 20) + 1, F.lit(20)) if lo is not None and hi > lo else F.lit(1)
    return polygons.groupBy("name", place.cast("long").alias("bin")).agg(F.count("*").alias("n"))


@query(O.polygons("SELECT name, roi FROM p WHERE include INTERSECT SELECT name, roi FROM p WHERE area >= 100"))
def id_set_intersect(spark: SparkSession, sf: str) -> DataFrame:
    polygons = _polygons(spark, sf)
    return polygons.where("include").select("name", "roi").intersect(polygons.where("area >= 100").select("name", "roi"))


# --- pixels -----------------------------------------------------------------------------------

LEVEL = 100


def _mask(spark: SparkSession, sf: str) -> DataFrame:
    return R.threshold_mask(R.select_channel(X.pixels(spark, sf), 1), LEVEL)


@query(O.particles("SELECT b.name, b.region, p.ch, count(*) AS area, round(avg(p.v), 6) AS mean, min(p.v) AS min, max(p.v) AS max FROM b JOIN px p USING (name, z, y, x) GROUP BY ALL"))
def measure_per_channel(spark: SparkSession, sf: str) -> DataFrame:
    found = R.measure(X.pixels(spark, sf), R.label_regions(_mask(spark, sf)))
    return _rounded(found.select("name", "region", "ch", "area", "mean", "min", "max"), "mean")


@query(O.particles("SELECT name, region, size, xmin, xmax, ymin, ymax, 4 * size - coalesce(inner_sides, 0) AS perimeter FROM (SELECT name, region, count(*) AS size, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax FROM b GROUP BY ALL) LEFT JOIN (SELECT u.name, u.region, count(*) AS inner_sides FROM b u JOIN b w ON u.name = w.name AND u.region = w.region AND abs(u.x - w.x) + abs(u.y - w.y) = 1 GROUP BY ALL) USING (name, region) WHERE size BETWEEN 3 AND 300"))
def pixel_threshold_particles(spark: SparkSession, sf: str) -> DataFrame:
    return R.particles(_mask(spark, sf), 3, 300).select("name", "region", "size", "xmin", "xmax", "ymin", "ymax", "perimeter")


@query(O.pixels("SELECT c.name, c.y, c.x, count(*) FILTER (n.v >= 100) = count(*) AS eroded, count(*) FILTER (n.v >= 100) > 0 AS dilated FROM px c JOIN px n ON n.name = c.name AND n.ch = c.ch AND abs(n.x - c.x) <= 1 AND abs(n.y - c.y) <= 1 WHERE c.ch = 1 GROUP BY ALL"))
def pixel_morphology(spark: SparkSession, sf: str) -> DataFrame:
    mask = _mask(spark, sf)
    both = R.erode(mask).select("name", "y", "x", F.col("on").alias("eroded")).join(R.dilate(mask).select("name", "y", "x", F.col("on").alias("dilated")), ["name", "y", "x"])
    return both.select("name", "y", "x", "eroded", "dilated")


@query(O.pixels("SELECT a.name, a.y, a.x, round(sum(b.v * exp(-((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)) / 2.0)) / sum(exp(-((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)) / 2.0)), 6) AS v FROM px a JOIN px b ON a.name = b.name AND a.ch = b.ch AND abs(a.x - b.x) <= 3 AND abs(a.y - b.y) <= 3 WHERE a.ch = 1 GROUP BY a.name, a.y, a.x"))
def pixel_blur(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(R.gaussian_blur(R.select_channel(X.pixels(spark, sf), 1), 1.0).select("name", "y", "x", "v"), "v")


@query(O.pixels("SELECT name, y, x, (SELECT max(v) FROM px q WHERE q.name = px.name AND q.ch = 1) - v AS v FROM px WHERE ch = 1"))
def pixel_invert(spark: SparkSession, sf: str) -> DataFrame:
    return R.invert(R.select_channel(X.pixels(spark, sf), 1)).select("name", "y", "x", "v")


@query(O.filled())
def pixel_fill_holes(spark: SparkSession, sf: str) -> DataFrame:
    return R.fill_holes(R.threshold_mask(R.select_channel(X.pixels(spark, sf), 1), -100)).select("name", "y", "x", "on")


@query(O.thresholds())
def pixel_auto_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(R.auto_threshold(X.pixels(spark, sf)).select("name", "ch", "threshold"), "threshold")


@query(O.fuzzy_thresholds(256))
def pixel_fuzzy_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return R.fuzzy_threshold(X.pixels(spark, sf)).select("name", "ch", "threshold")


@query(O.distances(-100))
def pixel_distance_map(spark: SparkSession, sf: str) -> DataFrame:
    mask = R.threshold_mask(R.select_channel(X.pixels(spark, sf), 1), -100)
    return _rounded(R.distance_map(mask).select("name", "y", "x", "on", "distance"), "distance")


@query(O.trimmed(-100, 2))
def pixel_trim(spark: SparkSession, sf: str) -> DataFrame:
    mask = R.threshold_mask(R.select_channel(X.pixels(spark, sf), 1), -100)
    return R.trim(mask, 500, 0.25).where("on").select("name", "y", "x")


def _region_polygons(mask: DataFrame) -> DataFrame:
    """Regions of a mask as polygons with holes."""
    rings = R.outline_rings(R.label_regions(mask))
    return as_polygons(rings.withColumn("roi", F.col("region").cast("string")))


@query(O.ringed())
def region_rings(spark: SparkSession, sf: str) -> DataFrame:
    """Area, holes and sides of each region, from its rings."""
    regions = _region_polygons(R.threshold_mask(R.select_channel(X.pixels(spark, sf), 1), 0))
    sides = G.perimeter(F.col("ring")) + F.aggregate("holes", F.lit(0.0), lambda total, h: total + G.perimeter(h))
    return regions.select("name", "region", "area", F.size("holes").cast("long").alias("n_holes"), sides.cast("long").alias("sides"))


@query(O.ring_overlaps())
def ring_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """What regions of high values in one channel share with regions of low ones in the other, both with holes."""
    pixels = X.pixels(spark, sf)
    high, low = (materialize(_region_polygons(R.threshold_mask(R.select_channel(pixels, ch), level)), "regions") for ch, level in ((1, LEVEL), (2, 0)))
    found = same_slice_pairs(high, low, ["region"])
    return found.select(F.col("name_a").alias("name"), F.col("region_a").alias("region_1"), F.col("region_b").alias("region_2"), F.round("int_area", 6).alias("int_area"))


MEASURED = "SELECT b.name, b.region, p.ch, count(*) AS area, round(avg(p.v), 6) AS mean, min(p.v) AS min, max(p.v) AS max FROM b JOIN px p USING (name, z, y, x) GROUP BY ALL"


@query(O.particles(MEASURED))
def measure_outlines(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels inside the outlines of regions, without their holes, measured in both channels."""
    regions = materialize(_region_polygons(_mask(spark, sf)), "regions")
    found = S.measure_selections(X.pixels(spark, sf), regions)
    return _rounded(found.select("name", F.col("roi").cast("long").alias("region"), "ch", "area", "mean", "min", "max"), "mean")


@query()
def select_nuclei(spark: SparkSession, sf: str) -> DataFrame:
    """From pixels to measured nuclei: blur, threshold, holes, particles, names, channels; a test does the same in plain Python."""
    measured = S.select_nuclei(X.pixels(spark, sf), 1, [1, 2], pixel_width=0.25, sigma=1.5, particle_size=(6 / 16, math.inf))[1]
    return _rounded(measured.select("name", "roi", "ch", "area", "mean", "min", "max"), "mean")


def _stacks(spark: SparkSession, sf: str) -> str:
    """The pixels as stack files in the shared folder."""
    path = scratch_path(spark, "stacks")
    stacks.write_stacks(X.pixels(spark, sf), path, pixel_width=0.25, unit="micron")
    return path


@query(O.pixels("SELECT name, ch, z, y, x, v FROM px"))
def stack_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels written as stacks and read back, a plane in a task."""
    return stacks.read_stacks(spark, _stacks(spark, sf)).select("name", "ch", "z", "y", "x", "v")


@query(O.pixels("SELECT name, ch, z, 1 AS frame, (max(x) + 1)::INT AS width, (max(y) + 1)::INT AS height, 0.25 AS pixel_width, 0.25 AS pixel_height, 'micron' AS unit, 4 * count(*) AS n_bytes FROM px GROUP BY ALL"))
def stack_planes(spark: SparkSession, sf: str) -> DataFrame:
    return stacks.read_stacks(spark, _stacks(spark, sf), "planes").select("name", "ch", "z", "frame", "width", "height", "pixel_width", "pixel_height", "unit", "n_bytes")


@query(O.pixels("SELECT name, count(*) AS n, sum(v)::DOUBLE AS total FROM px WHERE ch = 2 GROUP BY ALL"))
def stack_one_channel(spark: SparkSession, sf: str) -> DataFrame:
    """One channel of all stacks: the filter reaches the source, which opens no plane of the other."""
    own = R.select_channel(stacks.read_stacks(spark, _stacks(spark, sf)), 2)
    return own.groupBy("name").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query()
def pixel_outlines(spark: SparkSession, sf: str) -> DataFrame:
    """Corners, sides and area of the outer outline of every region; a test walks the same boundaries by brute force."""
    traced = R.outlines(R.label_regions(_mask(spark, sf)))
    following = F.lead("x").over(Window.partitionBy("name", "region").orderBy("ord"))
    first = F.first("x").over(Window.partitionBy("name", "region").orderBy("ord"))
    sided = traced.withColumn("nx", F.coalesce(following, first))
    return sided.groupBy("name", "region").agg(F.count("*").alias("sides"), F.sum((F.col("x") - F.col("nx")) * F.col("y")).alias("area"), F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"))
