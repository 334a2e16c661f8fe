"""Readers, labels, palettes, raster operators, streams."""

import shutil

import pytest
from pyspark.sql import functions as F

from roistack.functions import labels as L
from roistack.operators import raster as R
from roistack.operators.overlap import roi_polygons
from roistack.sources.tables import _is_row_number, append_outlines, in_file_order, read_measurements, read_outlines, write_outlines
from roistack.streaming.outlines import group_arriving, stream_outlines

from .test_geometry import SQUARE, rois


def test_measurements(spark, tmp_path):
    label = "sample1.lif/Position001:0007-0123-0456:c:1/3 z:7/72"
    lines = ["n\tLabel\tArea\tCirc.", f"1\t{label}\t10.5\t0.9", f"2\t{label.replace('z:7', 'q')}\t3\t0.4"]
    (tmp_path / "a_res.txt").write_text("\n".join(lines) + "\n")
    rows = read_measurements(spark, f"file://{tmp_path}/a_res.txt").orderBy("area").collect()
    assert rows[0].asDict().keys() == {"label", "area", "circ", "filename", "pos", "roi", "z"}
    assert (rows[1].filename, rows[1].pos, rows[1].roi, rows[1].z, rows[0].z) == ("sample1.lif", "Position001", "0007-0123-0456", 7, None)
    (tmp_path / "b_res.txt").write_text("n\tLabel\n1\tx\n3\ty\n")
    assert read_measurements(spark, f"file://{tmp_path}/b_res.txt").columns == ["n", "label", "z"]
    # all of the numbers, but not in order
    (tmp_path / "c_res.txt").write_text("n\tLabel\n2\tx\n1\ty\n")
    assert read_measurements(spark, f"file://{tmp_path}/c_res.txt").columns == ["n", "label", "z"]


def test_content_names(spark):
    df = spark.createDataFrame([("a.lif", "b.lif", "x", None), ("c.lif", "d.lif", "Position1", None)], "V1 string, V2 string, V3 string, V4 string")
    with pytest.warns(UserWarning, match="patterns that several columns match: filename"):
        assert L.name_by_content(df, df.columns) == {"V1": "filename", "V2": "filename_1"}
    with pytest.warns(UserWarning, match="columns that match several patterns: V1"):
        assert L.name_by_content(df.select("V1"), ["V1"], {"a": "lif", "b": "a|c"}) == {"V1": "b"}


def test_palette():
    assert L.palette(14) == L.PAIRED + L.PAIRED[:2]
    assert L.palette(10, name="Set1")[8:] == ["#999999", "#E41A1C"] and sum(map(len, L.PALETTES.values())) == 74
    with pytest.raises(ValueError, match="none of"):
        L.palette(3, name="Blue")
    assert len(L.palette(3, literal=True)) == 30 and L.palette(0) == [] and L.clean_name("Circ..") == "circ"


def test_outlines_round_trip(spark, tmp_path):
    df = rois(spark, [("a", 1, SQUARE), ("b", 2, SQUARE)])
    write_outlines(df.drop("ord").coalesce(1), f"file://{tmp_path}/o_outline")
    back = read_outlines(spark, f"file://{tmp_path}/o_outline")
    assert [(r.roi, r.x, r.y) for r in back.orderBy("ord").collect()] == [(r.roi, r.x, r.y) for r in df.orderBy("ord").collect()]
    for _ in range(2):
        append_outlines(spark, df, f"file://{tmp_path}/appended")
    assert [r.idx for r in read_outlines(spark, f"file://{tmp_path}/appended").orderBy("idx").collect()] == list(range(16))


def test_stream(spark, tmp_path):
    write_outlines(rois(spark, [(f"r{z}", z, SQUARE) for z in range(1, 7)]).drop("ord").coalesce(1), f"file://{tmp_path}/in")
    seen = []
    rows = stream_outlines(spark, f"file://{tmp_path}/in")
    group_arriving(rows, lambda df, n: seen.extend(df.select("feature_id").distinct().collect()), f"file://{tmp_path}/state").awaitTermination(120)
    assert [r.feature_id for r in seen] == ["feature_1"]


def test_stream_of_positions_in_several_files(spark, tmp_path):
    """A position, and a ROI, may be spread over files and batches; numbers follow the files' names, not their arrival."""
    rows = rois(spark, [(f"{t}{z}", z, [(x + d, y) for x, y in SQUARE]) for t, d in (("r", 0), ("s", 50)) for z in range(1, 7)]).drop("ord").collect()
    cuts = [0, 5, 23, 26, len(rows)]
    for k in (3, 1, 0, 2):
        part = spark.createDataFrame(rows[cuts[k] : cuts[k + 1]], "name string, roi string, z int, x double, y double").coalesce(1)
        write_outlines(part, f"file://{tmp_path}/part")
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / "part").glob("part-*.csv")).rename(tmp_path / "in" / f"{k}.csv")
        shutil.rmtree(tmp_path / "part")
    seen = {}
    arriving = stream_outlines(spark, f"file://{tmp_path}/in", max_files=1)
    group_arriving(arriving, lambda df, n: seen.update({n: {(r.roi, r.feature_id) for r in df.collect()}}), f"file://{tmp_path}/state", keep=True).awaitTermination(240)
    assert len(seen) == 4
    assert seen[3] == {(f"{t}{z}", f"feature_{n}") for n, t in ((1, "r"), (2, "s")) for z in range(1, 7)}


def grid(spark, picture):
    rows = [("im", 1, 1, y, x, float(c != ".")) for y, line in enumerate(picture) for x, c in enumerate(line)]
    return spark.createDataFrame(rows, "name string, ch int, z int, y int, x int, v double").withColumn("on", F.col("v") > 0)


def shown(df, column="on"):
    rows = {(r.y, r.x): r[column] for r in df.collect()}
    return ["".join("#" if rows[y, x] else "." for x in range(1 + max(k[1] for k in rows))) for y in range(1 + max(k[0] for k in rows))]


def test_raster(spark):
    ring = grid(spark, ["......", ".###..", ".#.#..", ".###.#", "......"])
    assert shown(R.fill_holes(ring)) == ["......", ".###..", ".###..", ".###.#", "......"]
    assert shown(R.dilate(grid(spark, ["...", ".#.", "..."]))) == ["###"] * 3
    assert shown(R.close(grid(spark, [".....", ".#.#.", "....."])))[1][2] == "#"
    found = {r.size: r for r in R.particles(ring).collect()}
    assert set(found) == {8, 1} and found[1].perimeter == 4
    assert [r.size for r in R.particles(ring, include_holes=True, exclude_edges=True).collect()] == [9]
    traced = R.outlines(R.label_regions(ring).where("x < 5")).orderBy("ord").collect()
    assert [(r.x, r.y) for r in traced] == [(1, 1), (2, 1), (3, 1), (4, 1), (4, 2), (4, 3), (4, 4), (3, 4), (2, 4), (1, 4), (1, 3), (1, 2)]
    flat = R.gaussian_blur(ring.withColumn("v", F.lit(3.0)), 1.0).agg(F.min("v"), F.max("v")).first()
    assert abs(flat[0] - 3) < 1e-9 and abs(flat[1] - 3) < 1e-9
    levels = spark.createDataFrame([("im", 1, 1, 0, x, v) for x, v in enumerate([0.0] * 5 + [10.0] * 5)], "name string, ch int, z int, y int, x int, v double")
    assert R.auto_threshold(levels).first().threshold == 5
    assert R.measure(ring, R.label_regions(ring)).agg(F.sum("area")).first()[0] == 9


def test_polygons_of_a_list(spark):
    vertices = rois(spark, [("a", 1, SQUARE), ("b", 1, [(0, 0), (1, 1), (0, 0)]), ("c", 1, SQUARE)]).union(rois(spark, [("n", 1, SQUARE)]).withColumn("x", F.lit(None).cast("double")))
    wanted = spark.createDataFrame([("p", "a"), ("p", "a"), ("p", "b"), ("p", "n"), ("p", "z"), ("q", "c")], "name string, roi string")
    with pytest.warns(UserWarning, match="p.b, p.n, p.z, q.c"):
        assert [r.roi for r in roi_polygons(vertices, wanted, 3).collect()] == ["a"]
    with pytest.warns(UserWarning, match="no coordinates"), pytest.raises(ValueError, match="No ROI"):
        roi_polygons(vertices, wanted.where("roi = 'z'"))


def test_parts_of_labels_in_one_look(spark):
    """Labels of different widths: a token that some labels lack has no name, and no row is shuffled to find out."""
    df = spark.createDataFrame([("a.lif/Position1 z:1",), ("b.lif/Position2 z:2/x",), ("b.lif/Position2 z:2/x",)], "label string")
    seen = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    assert sorted(L.parse_labels(df).columns) == ["filename", "label", "pos", "z"]
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - seen <= 2
    assert L.parse_labels(df.unionByName(df.limit(1).select(F.lit(None).cast("string").alias("label")))).columns == ["label", "z"]


def test_row_number_over_files(spark, tmp_path):
    """Row numbers that go on from file to file are found in one look."""
    spark.range(1, 4001).repartitionByRange(5, "id").sortWithinPartitions("id").write.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        table = spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/n")
        assert _is_row_number(table, "id")
        jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
        _is_row_number(table, "id")
        assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - jobs <= 3
        # the same numbers, two of them changed about
        swapped = F.when(F.col("id") == 7, 3500).when(F.col("id") == 3500, 7).otherwise(F.col("id"))
        spark.range(1, 4001).repartitionByRange(5, "id").sortWithinPartitions("id").select(swapped.alias("id")).write.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/s")
        assert not _is_row_number(spark.read.option("header", True).csv(f"file://{tmp_path}/s"), "id")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_order_of_compressed_outlines(spark, tmp_path):
    """Rows of compressed files in the order of the files, without a path in each."""
    df = rois(spark, [(f"r{k}", 1, SQUARE) for k in range(6)]).repartitionByRange(3, "ord").sortWithinPartitions("ord")
    write_outlines(df.select("name", "roi", "z", "x", "y"), f"file://{tmp_path}/o", compression="gzip")
    back = in_file_order(read_outlines(spark, f"file://{tmp_path}/o", pattern="*.csv.gz"))
    assert "path" not in back.columns
    assert [(r.roi, r.x, r.y) for r in back.orderBy("ord").collect()] == [(r.roi, r.x, r.y) for r in df.orderBy("ord").collect()]
