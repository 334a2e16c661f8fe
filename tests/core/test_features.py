"""Grouping and matching against a plain loop, and the documented quirks."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from roistack.operators import components, overlap
from roistack.operators.components import connected_components
from roistack.operators.features import as_polygons, component_table, define_feature_group, name_components
from roistack.operators.match import find_overlap_features, match_statistics
from roistack.plans.scratch import materialize

from .test_geometry import SQUARE, moved, rois


def sequential(n, edges):
    """Labels of an edge list in order: new, extended or merged to the smaller."""
    label, count = {}, 0
    for a, b in edges:
        known = {label[x] for x in (a, b) if x in label}
        if not known:
            count += 1
            known = {count}
        low = min(known)
        label.update({x: low for x in label if label[x] in known})
        label[a] = label[b] = low
    return label


def test_labels_and_numbers(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for g in range(12):
        edges = sorted({tuple(sorted(rng.sample(range(14), 2))) for _ in range(9)})
        for a, b in edges:
            rows.append((f"g{g}", b, a))
        expected[f"g{g}"] = sequential(14, edges)
    pairs = spark.createDataFrame(rows, "name string, ord_1 long, ord_2 long")
    nodes = [(f"g{g}", i, i % 5, float(i)) for g in range(12) for i in range(14)]
    survivors = spark.createDataFrame(nodes, "name string, ord long, z int, area double")
    members, table = component_table(survivors, pairs, labels=True)
    got = {}
    labels = {(r["name"], r.component): r.label for r in table.collect()}
    for r in members.collect():
        got.setdefault(r["name"], {})[r.ord] = labels[r["name"], r.component]
    assert got == expected
    for literal in (False, True):
        named = {(r["name"], r.component): r.feature_id for r in name_components(table, 2, None, "feature_", "invalid_", literal).collect()}
        spans = {(r["name"], r.component): r.n_z_span for r in table.collect()}
        for g in expected:
            order = sorted((labels[k], k) for k in labels if k[0] == g)
            ok = {place for place, (_, k) in enumerate(order, 1) if spans[k] >= 2} if literal else {label for label, k in order if spans[k] >= 2}
            rank = {label: i for i, label in enumerate(sorted(ok), 1)}
            wrong = iter(range(1, 99))
            for label, k in order:
                assert named[k] == (f"feature_{rank[label]}" if label in ok else f"invalid_{next(wrong)}")


def test_components(spark):
    edges = spark.createDataFrame([("a", i, i + 1) for i in range(20)] + [("b", 1, 2), ("b", 3, 3)], "name string, a long, b long")
    assert {(r["name"], r.node): r.component for r in connected_components(edges).collect()} == {**{("a", i): 0 for i in range(21)}, ("b", 1): 1, ("b", 2): 1}


def test_feature_labels(spark):
    shapes = [(f"nucleus_{z}", z, moved(SQUARE, 0.1 * z, 0)) for z in range(1, 7)] + [("nucleus_x", 1, moved(SQUARE, 10, 0)), ("nucleus_y", 2, moved(SQUARE, 10, 0)), ("other", 1, moved(SQUARE, 20, 0)), ("nucleus_big", 1, [(30, 0), (40, 0), (40, 10)]), ("nucleus_alone", 9, SQUARE), ("nucleus_out", 3, SQUARE)]
    df = rois(spark, shapes).withColumn("include", F.col("roi") != "nucleus_out")
    got = {r.roi: r.feature_id for r in define_feature_group(df, roi_regex="^nucleus", roi_area_range=(5, 0)).collect()}
    assert got == {**{f"nucleus_{z}": "feature_1" for z in range(1, 7)}, "nucleus_x": "invalid_feature_1", "nucleus_y": "invalid_feature_1", "other": "failed_ROI_name", "nucleus_big": "failed_ROI_area", "nucleus_alone": "failed_ROI_overlap", "nucleus_out": "failed_ROI_excluded"}
    assert {r.feature_id for r in define_feature_group(rois(spark, [("a", 1, SQUARE), ("b", 5, SQUARE)])).collect()} == {"failed_ROI_overlap"}
    with pytest.raises(ValueError, match="filters"):
        define_feature_group(df, roi_regex="nothing")
    with pytest.raises(ValueError, match="type of input"):
        define_feature_group(spark.createDataFrame([("a", 1)], "roi string, z int"))
    # without the slice filter every ROI overlaps itself
    assert "failed_ROI_overlap" not in {r.feature_id for r in define_feature_group(rois(spark, shapes), max_z_dist=math.inf).collect()}


def test_match(spark):
    def features(shapes, ids):
        df = define_feature_group(rois(spark, shapes), min_z_span=1, strict=False)
        return df.withColumn("feature_id", F.element_at(F.create_map(*[F.lit(x) for kv in ids.items() for x in kv]), F.col("roi")))

    small = [(0.2, 0.2), (0.4, 0.2), (0.4, 0.4), (0.2, 0.4)]
    inner = features([("i1", 1, small), ("i2", 2, small), ("i3", 3, moved(small, 5, 0))], {"i1": "feature_1", "i2": "feature_1", "i3": "feature_2"})
    outer = features([("o1", 1, SQUARE), ("o2", 2, SQUARE), ("o3", 3, SQUARE)], {"o1": "feature_a", "o2": "feature_a", "o3": "invalid_feature_b"})
    assert [(r.feature_id_1, r.feature_id_2) for r in find_overlap_features(inner, outer).collect()] == [("feature_1", "feature_a")]
    stats = {(r.f_id_1, r.f_id_2): (r.n_roi_1_ovl, r.ratio_roi_ovl) for r in match_statistics(inner, outer, all_pairs=True).collect()}
    assert stats == {("feature_1", "feature_a"): (2, 1.0), ("feature_1", "invalid_feature_b"): (0, 0.0), ("feature_2", "feature_a"): (0, 0.0), ("feature_2", "invalid_feature_b"): (0, 0.0)}
    assert find_overlap_features(inner, outer, min_ratio_roi_overlap=0).count() == 4
    assert find_overlap_features(inner, outer, "^feature_2").count() == 0


def _row_of_squares(spark, n: int, slices: int):
    vertices = [("p", f"r{i}_{z}", z, (i * slices + z) * 4 + k, 30.0 * i + x, float(y), True) for i in range(n) for z in range(slices) for k, (x, y) in enumerate(((0, 0), (10, 0), (10, 10), (0, 10)))]
    return as_polygons(spark.createDataFrame(vertices, "name string, roi string, z int, ord long, x double, y double, include boolean"))


def test_a_set_that_meets_itself_is_shuffled_once(spark):
    polygons = materialize(_row_of_squares(spark, 30, 8), "squares")
    assert overlap._placed(polygons, overlap.cell_size(polygons), [], 3, 16).count() < 1.5 * 30 * 8
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = overlap.find_z_intersect(polygons, 3)
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 30 * sum(8 - d for d in (1, 2, 3))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_positions_settle_where_their_edges_lie(spark, monkeypatch):
    def none(*_):
        raise AssertionError("joined")

    monkeypatch.setattr(components, "stars", none)
    edges = spark.createDataFrame([("p", 100 * i + k + 1, 100 * i + k) for i in range(30) for k in range(9)], "name string, a long, b long").coalesce(1)
    got = {r.node: r.component for r in connected_components(edges, local=100).collect()}
    assert got == {100 * i + k: 100 * i for i in range(30) for k in range(10)}


def test_scratch_tables_leave_no_shuffle_files(spark):
    files = lambda: {f for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split() if "shuffle_" in f}
    before = files()
    materialize(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "groups")
    for _ in range(100):
        # Spark removes them a moment later
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
