"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

from roistack.plans import catalogue

SF = "/root/testdata/sf0.001"
WITHOUT_SQL = {"pixel_outlines", "select_nuclei"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    for c in frame.columns:
        if frame[c].dtype.kind == "f":
            frame[c] = frame[c].round(5) + 0.0
    return sorted(map(str, frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(catalogue.ORACLE_SQL[name]).df())


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL) | WITHOUT_SQL


def test_outlines_against_brute_force(spark):
    """Of every region: the sides that face the background outside of it, found by a flood from beyond its box."""
    from roistack.operators import raster as R

    regions = {}
    for r in R.label_regions(catalogue._mask(spark, SF)).select("name", "region", "x", "y").collect():
        regions.setdefault((r["name"], r.region), set()).add((r.x, r.y))
    expected = {}
    for key, cells in regions.items():
        xs, ys = [x for x, _ in cells], [y for _, y in cells]
        outside, todo = set(), [(min(xs) - 1, min(ys) - 1)]
        while todo:
            x, y = todo.pop()
            if (x, y) in outside or (x, y) in cells or not (min(xs) - 1 <= x <= max(xs) + 1 and min(ys) - 1 <= y <= max(ys) + 1):
                continue
            outside.add((x, y))
            # a walk that keeps to a region's own boundary lets the background through between pixels that touch at a corner
            todo += [(x + dx, y + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
        sides = sum((x + dx, y + dy) in outside for x, y in cells for dx, dy in ((0, 1), (1, 0), (0, -1), (-1, 0)))
        area = (max(xs) - min(xs) + 3) * (max(ys) - min(ys) + 3) - len(outside)
        expected[key] = (sides, area, min(xs), max(xs) + 1, min(ys), max(ys) + 1)
    got = {(r["name"], r.region): (r.sides, round(abs(r.area)), r.xmin, r.xmax, r.ymin, r.ymax) for r in catalogue.pixel_outlines(spark, SF).collect()}
    assert len(got) == len(expected) and max(len(c) for c in regions.values()) > 10
    assert {k: (got[k], v) for k, v in expected.items() if got[k] != v} == {}


def test_nucleus_map_groups_nucleoli_once(spark):
    """What the map joins is the table of grouped nucleoli, not another grouping of them."""
    files = catalogue.QUERIES["nucleus_map"](spark, SF).inputFiles()
    assert any("/nucleoli-" in f for f in files) and not any("/nodes-" in f for f in files)
