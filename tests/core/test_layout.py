"""Appends, the white-space reader, and polygons stored along a curve."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roistack.functions.geometry import hilbert
from roistack.operators.features import as_polygons
from roistack.sources.appends import Append, append_rows, commit, history, remove_abandoned
from roistack.sources.tables import append_outlines, read_outlines, read_polygons, write_outlines, write_polygons

from .test_geometry import SQUARE, moved, rois


def numbers(spark, path, **more):
    return [r.idx for r in read_outlines(spark, path, **more).orderBy("idx").collect()]


def test_appends_are_whole_and_made_once(spark, tmp_path):
    path, df = f"file://{tmp_path}/t", rois(spark, [("a", 1, SQUARE), ("b", 2, SQUARE)])
    assert append_outlines(spark, df, path, "first").first == 0
    again = append_outlines(spark, df, path, "first")
    assert (again.version, again.rows) == (1, 8) and numbers(spark, path) == list(range(8))
    append_outlines(spark, df.where("roi = 'b'"), path)
    assert numbers(spark, path) == list(range(12)) and numbers(spark, path, version=1) == list(range(8))
    assert append_outlines(spark, df.limit(0), path).rows == 0

    def fails(folder, first):
        write_outlines(df.select(F.lit(first).alias("idx"), "name", "roi", "z", "x", "y"), folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        append_rows(spark, path, 8, fails)
    assert numbers(spark, path) == list(range(12)) and [a.version for a in history(spark, path)] == [1, 2, 3]
    assert len(remove_abandoned(spark, path)) == 1 and remove_abandoned(spark, path) == []
    assert numbers(spark, path) == list(range(12))


def test_the_slower_of_two_writers_numbers_anew(spark, tmp_path):
    path, begun = f"file://{tmp_path}/t", []

    def write(folder, first):
        begun.append(first)
        spark.range(2).select((F.col("id") + first).alias("idx"), F.lit("p").alias("name")).write.option("sep", "\t").option("header", True).csv(folder)
        if len(begun) == 1:  # meanwhile another append is committed
            spark.range(3).select(F.col("id").alias("idx"), F.lit("q").alias("name")).write.option("sep", "\t").option("header", True).csv(f"{path}/append-other")
            assert commit(spark, path, Append(1, "append-other", 0, 3))
            assert not commit(spark, path, Append(1, "append-third", 0, 3))

    mine = append_rows(spark, path, 2, write)
    assert begun == [0, 3] and (mine.version, mine.first) == (2, 3)
    assert [(r.idx, r["name"]) for r in read_outlines(spark, path).orderBy("idx").collect()] == [(0, "q"), (1, "q"), (2, "q"), (3, "p"), (4, "p")]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("append-")]) == 2


def test_a_table_without_a_log_is_its_first_version(spark, tmp_path):
    path = f"file://{tmp_path}/old"
    spark.range(5).select(F.col("id").alias("idx"), F.lit("p").alias("name"), F.lit("r").alias("roi"), F.lit(1).alias("z"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).write.option("sep", "\t").option("header", True).csv(path)
    assert append_outlines(spark, rois(spark, [("a", 1, SQUARE)]), path).first == 5
    assert numbers(spark, path) == list(range(9)) and numbers(spark, path, version=1) == list(range(5))


def test_white_space(spark, tmp_path):
    (tmp_path / "a_outline.txt").write_text('"name" "roi"   z\tx y\n\n1 "Position 1" nucleus_1 3  1.5 2\n"2" P2 \'n 2\' NA -1e2 .5\n   3 P2 n#3 4 7 8  \n')
    (tmp_path / "b_outline.txt").write_text('"name" "roi" "z" "x" "y"\nP3 n 1 0 0\n')
    (tmp_path / "other.txt").write_text("x\n1\n")
    rows = read_outlines(spark, f"file://{tmp_path}", pattern="*_outline.txt", white_space=True).orderBy("path", "ord").collect()
    assert [(r["name"], r.roi, r.z, r.x, r.y) for r in rows] == [("Position 1", "nucleus_1", 3, 1.5, 2.0), ("P2", "n 2", None, -100.0, 0.5), ("P2", "n#3", 4, 7.0, 8.0), ("P3", "n", 1, 0.0, 0.0)]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.txt").write_text("\n")
    with pytest.raises(ValueError, match="no header"):
        read_outlines(spark, f"file://{tmp_path}/empty", white_space=True)


@pytest.mark.parametrize("bits", [1, 4])
def test_hilbert(spark, bits):
    """Each cell has a place of its own, and the next one lies beside it."""
    side = 1 << bits
    cells = spark.range(side * side).select((F.col("id") % side).alias("x"), F.floor(F.col("id") / side).alias("y"))
    at = {r.d: (r.x, r.y) for r in cells.withColumn("d", hilbert(F.col("x"), F.col("y"), bits)).collect()}
    assert sorted(at) == list(range(side * side)) and at[0] == (0, 0)
    assert all(abs(at[d][0] - at[d + 1][0]) + abs(at[d][1] - at[d + 1][1]) == 1 for d in range(side * side - 1))


def test_layout_leaves_files_out(spark, tmp_path):
    path = f"file://{tmp_path}/polygons"
    shapes = [(f"r{x}_{y}", 1, moved(SQUARE, 3 * x, 3 * y)) for x in range(24) for y in range(24)]
    write_polygons(as_polygons(rois(spark, shapes)).repartition(5, "roi"), path, files=36)
    files = list((tmp_path / "polygons").rglob("*.parquet"))
    assert len(files) > 24
    box = (10.0, 10.0, 17.5, 16.0)
    found = read_polygons(spark, path, box)
    assert {r.roi for r in found.collect()} == {f"r{x}_{y}" for x in range(3, 6) for y in range(3, 6)}
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(xmax,10.0)" in plan

    def met(f):
        stats = pq.ParquetFile(f).metadata.row_group(0)
        ends = {stats.column(k).path_in_schema: stats.column(k).statistics for k in range(stats.num_columns)}
        return ends["xmax"].max >= box[0] and ends["xmin"].min <= box[2] and ends["ymax"].max >= box[1] and ends["ymin"].min <= box[3]

    assert 0 < sum(map(met, files)) <= len(files) / 4
    assert read_polygons(spark, path).count() == 576 and read_polygons(spark, path, names=["q"]).count() == 0
    same = as_polygons(rois(spark, [("a", 1, SQUARE), ("b", 1, SQUARE)]))
    write_polygons(same, f"file://{tmp_path}/same")
    assert read_polygons(spark, f"file://{tmp_path}/same", (1, 1, 2, 2)).count() == 2
