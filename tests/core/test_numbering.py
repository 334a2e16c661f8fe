"""Numbers over range partitions and components, against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roistack.operators.components import connected_components
from roistack.operators.numbering import numbered, running_total


def test_numbers_and_totals(spark):
    """One large group, small ones, a null one; strings and negative numbers in the order; few rows and none."""
    rng = random.Random(1)
    rows = [(rng.choice(["big"] * 9 + ["b", None, "c"]), rng.choice("xyz"), i, rng.randint(-5, 9)) for i in rng.sample(range(-900, 900), 1500)]
    df = spark.createDataFrame(rows, "g string, s string, k long, v int").repartition(7)
    got = {(r.g, r.s, r.k): (r.n, r.total) for r in running_total(numbered(df, ["g"], ["s", "k"]), ["g"], ["s", "k"], F.col("v"), "total").collect()}
    expected, groups = {}, defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    for own in groups.values():
        total = 0
        for n, (g, s, k, v) in enumerate(sorted(own, key=lambda r: r[1:3]), 1):
            total += v
            expected[g, s, k] = (n, total)
    assert got == expected
    assert [r.n for r in numbered(df, [], ["k"]).orderBy("k").collect()] == list(range(1, 1501))
    assert numbered(df.limit(0), ["g"], ["k"]).count() == 0
    assert [r.n for r in numbered(df.limit(1), ["g"], ["k"]).collect()] == [1]


@pytest.mark.parametrize("local", [10**6, 40, 0])
def test_components(spark, local):
    """Paths, stars and random graphs in several positions, each within a task, or by joins, or some of both."""
    rng = random.Random(3)
    edges = [("path", i, i + 1) for i in range(60)] + [("star", 5, i) for i in range(30)] + [("loops", 1, 1), ("loops", 2, 1)] + [(None, 3, 4)]
    edges += [(f"r{k}", rng.randrange(50), rng.randrange(50)) for k in range(4) for _ in range(20 + 10 * k)]
    got = {(r["name"], r.node): r.component for r in connected_components(spark.createDataFrame([*edges, *edges[:9]], "name string, a long, b long").where("name IS NOT NULL" if local < 10**6 else "true"), local=local).collect()}
    label = {}
    for n, a, b in edges:
        if a != b and (n is not None or local == 10**6):
            label[n, a], label[n, b] = a, b
    changed = True
    while changed:
        changed = False
        for n, a, b in edges:
            if (n, a) in label and label[n, a] != label[n, b]:
                label[n, a] = label[n, b] = min(label[n, a], label[n, b])
                changed = True
    assert got == label
