"""ROIs of a position, grouped over slices into labelled features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import materialize
from .components import connected_components
from .numbering import numbered
from .overlap import find_z_intersect, measured, polygonize


def as_polygons(rois: DataFrame) -> DataFrame:
    """Measured polygons from vertex rows (x, y, z: they take precedence) or from rows with a ring or geometry."""
    if {"x", "y", "z"} <= set(rois.columns):
        return measured(polygonize(rois))
    rois = rois.withColumnRenamed("geometry", "ring")
    kind = dict(rois.dtypes).get("ring", "")
    if not (kind.startswith("array<struct<x:") and "y:" in kind):
        raise ValueError("Incorrect type of input")
    rois = rois if "name" in rois.columns else rois.withColumn("name", F.lit(""))
    rois = rois if "ord" in rois.columns else numbered(rois, ["name"], ["z", "roi"], "ord")
    return measured(rois)


def fail_reasons(polygons: DataFrame, include: str | None = "include", area_range: tuple[float, float] | None = (0, math.inf), roi_regex: str | None = None) -> DataFrame:
    """``polygons`` with fail_reason: the first of excluded, name and area that holds, else null."""
    reason = F.lit(None).cast("string")
    if area_range is not None:
        lo, hi = min(area_range), max(area_range)
        reason = F.when(~F.col("area").between(lo, hi), "area").otherwise(reason)
    if roi_regex is not None:
        reason = F.when(~F.coalesce(F.col("roi").rlike(roi_regex), F.lit(False)), "name").otherwise(reason)
    if include and include in polygons.columns:
        flag = F.when(F.col(include).isNull(), F.raise_error(F.lit(f"{include} holds a null"))).otherwise(F.col(include))
        reason = F.when(~flag, "excluded").otherwise(reason)
    return polygons.withColumn("fail_reason", reason)


def stop_where_empty(tested: DataFrame) -> None:
    """Raise an error that names a position without any ROI left and the filter that took its last ones."""
    last = F.max(F.when(F.col("fail_reason") == "area", 3).when(F.col("fail_reason") == "name", 2).when(F.col("fail_reason") == "excluded", 1))
    empty = tested.groupBy("name").agg(F.count_if(F.col("fail_reason").isNull()).alias("n"), last.alias("last")).where("n = 0").orderBy("name").first()
    if empty:
        reason = {1: "flag", 2: "name", 3: "area"}[empty["last"]]
        raise ValueError(f"No ROI of position {empty['name']!r} passes the filters: the last ones fail by {reason}")


def filter_features(features: DataFrame, regex: str, fold_case: bool = False) -> DataFrame:
    """Rows whose feature_id matches; ``fold_case``: looked for in the id's lower case."""
    feature_id = F.lower("feature_id") if fold_case else F.col("feature_id")
    return features.where(feature_id.rlike(regex))


def slice_by_rank(df: DataFrame, rank: int) -> DataFrame:
    """Rows on the slice that is the ``rank``-th, from 1, of all slices there are; none beyond the last."""
    slices = [r["z"] for r in df.select("z").distinct().orderBy("z").limit(rank).collect()]
    return df.where(F.col("z") == slices[-1]) if len(slices) == rank else df.limit(0)


def edge_order(pairs: DataFrame) -> DataFrame:
    """Pairs with edge_idx, their place in a position by roi_2 and then roi_1, and opens: both ROIs are met first here."""
    indexed = numbered(pairs, ["name"], ["ord_2", "ord_1"], "edge_idx")
    ends = indexed.select("name", "edge_idx", F.explode(F.array("ord_1", "ord_2")).alias("node"))
    met = ends.groupBy("node", "name").agg(F.min("edge_idx").alias("met"))
    one, two = (met.select("name", F.col("node").alias(f"ord_{k}"), F.col("met").alias(f"met_{k}")) for k in (1, 2))
    return indexed.join(one, ["ord_1", "name"]).join(two, ["ord_2", "name"]).select(*indexed.columns, "met_1", "met_2").withColumn("opens", (F.col("edge_idx") == F.col("met_1")) & (F.col("edge_idx") == F.col("met_2")))


def component_table(survivors: DataFrame, pairs: DataFrame, labels: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes (name, ord, component), and for each component its first edge (ord_2, ord_1), slice span and mean area.

    ``labels``: also the label that its first edge opens, the number of edges up to there that open one.
    """
    nodes = materialize(connected_components(pairs.select("name", F.col("ord_1").alias("a"), F.col("ord_2").alias("b"))).withColumnRenamed("node", "ord"), "nodes")
    alone = pairs.where("ord_1 = ord_2").select("name", F.col("ord_1").alias("ord"), F.col("ord_1").alias("component"))
    if not alone.isEmpty():
        nodes = nodes.unionByName(alone.distinct().join(nodes, ["ord", "name"], "left_anti"))
    # the number leads the keys: rows are sorted by it, not by names that begin alike
    begins = pairs.groupBy(F.col("ord_1").alias("ord"), "name").agg(F.min("ord_2").alias("ord_2"))
    rows = survivors.select("name", "ord", "z", "area").join(nodes, ["ord", "name"]).join(begins, ["ord", "name"], "left")
    edge = F.when(F.col("ord_2").isNotNull(), F.struct("ord_2", F.col("ord").alias("ord_1")))
    found = rows.groupBy("component", "name").agg(F.count_distinct("z").alias("n_z_span"), F.avg("area").alias("mean_area"), F.count("*").alias("n_roi"), F.min(edge).alias("first_edge"))
    found = found.select("name", "component", "n_z_span", "mean_area", "n_roi", "first_edge")
    if labels:
        # a component's first edge opens its label
        opened = numbered(edge_order(pairs).where("opens").select("name", "ord_2", "ord_1", "edge_idx"), ["name"], ["edge_idx"], "label")
        found = found.join(opened.select("name", F.struct("ord_2", "ord_1").alias("first_edge"), "label"), ["name", "first_edge"])
    return nodes, found


def name_components(components: DataFrame, min_z_span: int, min_avg_area: float | None, prefix: str, invalid_prefix: str, literal: bool) -> DataFrame:
    """name, component and feature_id.

    ``literal``: the slice-span test is looked up by the rank of a label rather than the label, which
    differs once a merge has left a gap in the labels, and numbers count the looked-up labels.
    """
    wide, large = F.col("n_z_span") >= min_z_span, F.lit(True) if min_avg_area is None else F.col("mean_area") >= min_avg_area
    if not literal:
        valid = components.withColumn("valid", wide & large)
        named = numbered(valid, ["name", "valid"], ["first_edge"], "number")
    else:
        ranked = numbered(components, ["name"], ["label"], "place")
        spans = ranked.where(wide).select("name", F.col("place").alias("label"))
        spans = spans if min_avg_area is None else spans.join(ranked.where(large).select("name", "label"), ["name", "label"], "left_semi")
        spans = numbered(spans, ["name"], ["label"], "valid_number")
        valid = ranked.join(spans, ["name", "label"], "left").withColumn("valid", F.col("valid_number").isNotNull())
        named = numbered(valid, ["name", "valid"], ["first_edge"], "number").withColumn("number", F.coalesce("valid_number", "number"))
    return named.withColumn("feature_id", F.concat(F.when(F.col("valid"), prefix).otherwise(invalid_prefix), F.col("number").cast("string"))).select("name", "component", "feature_id")


def define_feature_group(
    rois: DataFrame, pre_roi_filter_colname: str | None = "include", roi_area_range: tuple[float, float] | None = (0, math.inf), roi_regex: str | None = None, min_intersect_ratio: float | None = 0.0,
    max_z_dist: float | None = 1, min_z_span: int = 5, min_avg_area: float | None = None, feature_prefix: str = "feature_", invalid_feature_prefix: str = "invalid_feature_",
    fail_roi_prefix: str = "failed_ROI_", compat: str = "intended", strict: bool = True, cell: float | None = None,
) -> DataFrame:
    """name, roi, z, ord, ring, area and feature_id of every ROI of every position.

    A ROI fails by the first of: flag, name, area, no overlap with a neighbouring slice.  Of the others, connected
    groups that span ``min_z_span`` slices (and have the mean area) become features, the rest invalid features.
    ``strict``: raise an error where a test leaves a position's table without any ROI.
    """
    tested = materialize(fail_reasons(as_polygons(rois), pre_roi_filter_colname, roi_area_range, roi_regex), "rois")
    survivors = tested.where("fail_reason IS NULL")
    if strict:
        stop_where_empty(tested)
    pairs = materialize(find_z_intersect(survivors, max_z_dist, min_intersect_ratio, cell).select("name", "ord_1", "ord_2"), "pairs")
    nodes, components = component_table(survivors, pairs, compat == "literal")
    named = nodes.join(name_components(components, min_z_span, min_avg_area, feature_prefix, invalid_feature_prefix, compat == "literal"), ["component", "name"]).select("name", "ord", "feature_id")
    failed = F.concat(F.lit(fail_roi_prefix), F.coalesce("fail_reason", F.lit("overlap")))
    out = tested.join(named, ["ord", "name"], "left").select(*tested.columns, "feature_id").withColumn("feature_id", F.coalesce("feature_id", failed))
    return out.drop("fail_reason", "ori", "xmin", "ymin", "xmax", "ymax")
